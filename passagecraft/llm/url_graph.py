"""URL filters: rules on hosts and paths, and trust carried along links between hosts.

Hosts that rules allow are trusted seeds, hosts that rules block are distrusted ones.
Trust flows along links (who a trusted host links to), distrust flows against them (who
links to a blocked host), both as personalised PageRank. A host that ends with more
distrust than trust is blocked. A rule that blocks a part of a host blocks the pages in that
part, and says nothing against the host itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from passagecraft.functions import sizing
from passagecraft.functions.sizing import fits_broadcast, split_join
from passagecraft.llm.tables import stage


# (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Rounds that are always made, and after how many each the ranks are written and looked at.
DAMPING, ROUNDS, ROUNDS_PER_STAGE = 0.85, 12, 4
# Rounds end once no new host is reached and a host's trust and distrust changed by at most
# this share of their own value in a round.
TOLERANCE = 1e-6
# Distrust over trust from which on a host is blocked.
DISTRUST_RATIO = 1.0
# Fixed value: the target of a link in a page's markup.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits as ``struct<rule, verdict, whole>``, or null; ``whole`` if its path is all of the host.

    A rule fits its host and all subdomains if the path starts with the rule's. Of two
    rules that read alike the first given counts. The rules are a short list: each is one
    condition of the plan.
    """
    found = F.lit(None).cast("struct<rule: string, verdict: string, whole: boolean>")
    for verdict, of, path_start in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(path_start))
        found = F.when(fits, F.struct(
            F.lit(of + path_start).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(path_start in ("", "/")).alias("whole"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """``src``, ``dst``: pairs of different hosts of which a page of one links to the other."""
    target = F.explode_outer(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    links = pages.select(host_of(F.col("url")).alias("src"), target.alias("to"))
    links = links.select("src", host_of(F.when(F.startswith("to", F.lit("//")), F.concat(F.lit("x:"), "to")).otherwise(F.col("to"))).alias("dst"))
    return links.filter("src != '' and dst != '' and src != dst").distinct()


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Trust and distrust of hosts once they have settled, after ``rounds`` rounds at least.

    ``seeds``: host, trusted, blocked (booleans). A host passes its trust in equal parts to
    the hosts it links to, and its distrust in equal parts to those that link to it; each
    round the seeds get ``1 - damping`` anew. The number of rounds follows the longest way
    from a seed and the tolerance. Returns ``host, trust, distrust`` for hosts that have some.
    """
    trusted, blocked = (seeds.filter(c).count() or 1 for c in ("trusted", "blocked"))
    start = stage(
        seeds.select(
            "host", F.when(F.col("trusted"), 1.0 / trusted).otherwise(0.0).alias("trust"),
            F.when(F.col("blocked"), 1.0 / blocked).otherwise(0.0).alias("distrust"),
        ).filter("trust > 0 or distrust > 0"), "seeds")
    out_degree = links.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    in_degree = links.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0.0)
    ways = (
        links.join(out_degree, "src").select(F.col("src").alias("host"), F.col("dst").alias("to"), (1 / F.col("n")).alias("w_trust"), none.alias("w_distrust"))
        .union(links.join(in_degree, "dst").select("dst", "src", none, 1 / F.col("n"))))
    # A host with very many links is spread over several tasks; few hosts can be that large.
    most = max(sizing.HOT_KEY_ROWS, -(-2 * links.count() // sizing.HOT_KEY_LIMIT))
    sizes = ways.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("parts"))
    hot = stage(sizes.filter("parts > 1"), "large-hosts")
    part = F.pmod(F.xxhash64("to"), F.coalesce("parts", F.lit(1))).cast("int")
    ways = stage(ways.join(F.broadcast(hot), "host", "left").withColumn("part", part).drop("parts"), "ways")
    hot = None if hot.isEmpty() else hot
    rank, k, settled = start, 0, False
    while not settled:
        before = rank
        moved = ways.join(_in_parts(rank, hot), ["host", "part"]).select(
            F.col("to").alias("host"), (damping * F.col("trust") * F.col("w_trust")).alias("trust"),
            (damping * F.col("distrust") * F.col("w_distrust")).alias("distrust"))
        again = start.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust"))
        rank = moved.union(again).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        k += 1
        # The last round before a look starts from a written table, which it is compared with.
        if k % ROUNDS_PER_STAGE in (0, ROUNDS_PER_STAGE - 1):
            rank = stage(rank, "ranks")
        if k % ROUNDS_PER_STAGE == 0 and k >= rounds:
            settled = _settled(before, rank, tolerance)
    return rank


def _in_parts(rank: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``rank`` with a row for each part that the links of a host are spread over."""
    if hot is None:
        return rank.withColumn("part", F.lit(0))
    parts = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    return rank.join(F.broadcast(hot), "host", "left").withColumn("part", F.explode(parts)).drop("parts")


def _settled(before: DataFrame, after: DataFrame, tolerance: float) -> bool:
    """Whether no host gained its first trust or distrust and none changed by more than ``tolerance`` of its value."""
    old = before.select("host", F.col("trust").alias("t"), F.col("distrust").alias("d"))
    moves = lambda new, was: F.abs(F.col(new) - F.coalesce(was, F.lit(0.0))) > tolerance * F.col(new)
    return after.join(old, "host", "left").filter(moves("trust", "t") | moves("distrust", "d")).isEmpty()


def judge_hosts(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, ratio: float = DISTRUST_RATIO) -> DataFrame:
    """``host, trust, distrust, verdict`` for hosts that trust or distrust has reached.

    A host is a trusted seed if rules allow pages of it and block none, a blocked one if
    rules without a path block some and no rule allows any. A host is blocked if its
    distrust is more than ``ratio`` times its trust.
    """
    urls = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = rule_of(F.col("host"), F.col("path"), rules).alias("r")
    some = lambda condition: F.coalesce(F.max(F.expr(condition)), F.lit(False))
    seeds = (
        urls.filter("host != ''").select("host", found).groupBy("host")
        .agg(some("r.verdict = 'allow'").alias("a"), some("r.verdict = 'block'").alias("b"), some("r.verdict = 'block' and r.whole").alias("all_of_it"))
        .select("host", F.expr("a and not b").alias("trusted"), F.expr("all_of_it and not a").alias("blocked"))
    )
    ranked = propagate(stage(seeds, "hosts"), stage(host_links(pages), "host-links"))
    blocked = F.col("distrust") > ratio * F.col("trust")
    return ranked.withColumn("verdict", F.when(blocked, "block").otherwise("allow"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, ratio: float = DISTRUST_RATIO) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every page: the rule's verdict, else the host's.

    A host without trust or distrust is allowed. A null url, or one without ``://``, has
    an empty host and path and is allowed. Repeated rows get a row each; a null html has
    no links. Other columns are not looked at.
    """
    hosts = stage(judge_hosts(pages, rules, ratio).select("host", F.col("verdict").alias("by_host")), "judged-hosts")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    blocked = hosts.filter("by_host = 'block'")
    if fits_broadcast(blocked):
        judged = rows.join(F.broadcast(blocked), "host", "left")
    else:
        # Each host has a row, so that the join can spread the pages of a large one.
        judged = split_join(rows, rows.select("host").distinct().join(blocked, "host", "left"), ["host"], ["page_id"])
    return judged.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", "by_host", F.lit("allow")).alias("verdict"))
