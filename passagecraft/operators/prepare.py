"""Preparation of pages, texts and dialogues for analysis and training. Rows go out as they come unless said."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from passagecraft.functions.sizing import broadcast_if, match, stage, top_k
from passagecraft.functions.text import hash28, pieces, tokens, unnest

# Parts of an address that do not name another page, common words by
# language, and marks counted as symbols or as the end of a sentence.
MIRROR = r"^(?:www|m|blog)\."
PAGE_END = r"(?:/index)?(?:\.html?)?/*$"
HREF = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""
STOP_WORDS = {
    "de": ["der", "die", "und", "das", "den", "nicht", "mit", "ist", "von", "im", "sich", "auf"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "with", "are"],
    "es": ["el", "los", "las", "y", "una", "por", "con", "para", "su", "lo", "como", "del"],
    "fr": ["le", "les", "et", "des", "est", "dans", "pour", "pas", "au", "sur", "avec", "ou"],
}
SYMBOLS = r"[#*$%&|<>]"
LINE_STOPS = r"[.!?…][\"')»”]?\s*$"
CONTROL = r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}]"


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def host_of(url: Column | str) -> Column:
    """The host of an address in lower case, empty if it has none."""
    return _host(F.col(url) if isinstance(url, str) else url)


def canonical_address(url: Column | str) -> Column:
    """Host and path without mirror prefix, page ending and trailing slashes; null without a host."""
    url = F.col(url) if isinstance(url, str) else url
    host = F.regexp_replace(_host(url), MIRROR, "")
    return F.when(host != "", F.concat(host, F.regexp_replace(_path(url), PAGE_END, "")))


def canonical_urls(pages: DataFrame) -> DataFrame:
    """One row per canonical address: ``canon, host, path, page_id`` (the smallest) and ``n_pages``.

    Scheme, port, mirror prefixes, query, fragment, trailing slashes and page endings do
    not count. Pages without a host are left out. Counts and smallest ids are summed up before the shuffle, so an address
    of very many pages is no hot key.
    """
    host = F.regexp_replace(_host(F.col("url")), MIRROR, "")
    path = F.regexp_replace(_path(F.col("url")), PAGE_END, "")
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).filter("host <> ''")
    return rows.groupBy("host", "path").agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n_pages")).select(
        F.concat("host", "path").alias("canon"), "host", "path", "page_id", "n_pages")


def block_hosts(pages: DataFrame, blocked: DataFrame) -> DataFrame:
    """``pages`` without those whose host is, or lies below, a domain in column ``domain`` of ``blocked``.

    Hosts are looked up once each: every host and its parent domains meet the list, of any
    size, on the domain, and pages meet the hosts that are left. Both joins broadcast the
    smaller side if its measured size allows and else split hot keys, such as a host with
    most pages or a top-level domain. Case and a leading or trailing dot do not count in
    ``blocked``; null and repeated domains change nothing. Pages without a host are kept.
    """
    named = pages.withColumn("_host", F.coalesce(_host(F.col("url")), F.lit("")))
    hosts = stage(named.filter("_host <> ''").select("_host").distinct(), "hosts")
    labels = F.split("_host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    listed = blocked.select(F.lower(F.regexp_replace("domain", r"^\.+|\.+$", "")).alias("_domain")).filter("_domain <> ''").distinct()
    found = match(hosts.select("_host", F.explode(parents).alias("_domain")), listed, ["_domain"], ["_host"]).select("_host").distinct()
    left = hosts.join(found, "_host", "left_anti")
    kept = match(named.filter("_host <> ''"), left, ["_host"], ["page_id"]).select(*pages.columns)
    return kept.unionByName(named.filter("_host = ''").select(*pages.columns))


def outlinks(pages: DataFrame) -> DataFrame:
    """``page_id, source, target``: one row per link, relative ones taken on the page's host; fragments are left out."""
    found = unnest(pages, ["page_id", _host(F.col("url")).alias("source")], F.regexp_extract_all("html", F.lit(HREF), F.lit(1)), "href")
    bare = F.regexp_replace("href", "#.*$", "")
    whole = F.concat(_host(bare), _path(bare))
    target = F.when(F.contains(bare, F.lit("://")), whole).when(F.startswith(bare, F.lit("/")), F.concat("source", bare))
    return found.select("page_id", "source", F.regexp_replace(target, r"/+$", "").alias("target")).filter("target <> ''")


def in_degree(links: DataFrame) -> DataFrame:
    """``target``, links to it and pages that hold one."""
    once = links.groupBy("target", "page_id").agg(F.count(F.lit(1)).alias("n"))
    return once.groupBy("target").agg(F.sum("n").alias("n_links"), F.count(F.lit(1)).alias("n_pages"))


def normalize_text(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` without control characters, with one kind of line end, single spaces,
    at most one empty line in a row and none at the ends."""
    lines = F.regexp_replace(F.regexp_replace("text", r"\r\n?", "\n"), CONTROL, "")
    spaced = F.regexp_replace(F.regexp_replace(lines, r"[ \t\x{A0}]+", " "), " ?\n ?", "\n")
    return docs.withColumn("text", F.regexp_replace(F.regexp_replace(spaced, "\n{3,}", "\n\n"), r"^[ \n]+|[ \n]+$", ""))


def detect_lang(docs: DataFrame, lexicon: dict[str, list[str]] | None = None) -> DataFrame:
    """``doc_id, guess, hits``: the language with most stop words in the text, ``und`` without any.

    Ties go to the language named first in the alphabet. One narrow pass: the lexicon is a
    short list per language and part of the plan.
    """
    lexicon = lexicon or STOP_WORDS

    def found(at: int, lang: str) -> Column:
        hits = F.size(F.filter("_t", lambda t: t.isin(lexicon[lang])))
        return F.struct(hits.alias("hits"), F.lit(-at).alias("at"), F.lit(lang).alias("lang"))

    counts = F.array(*[found(i, lang) for i, lang in enumerate(sorted(lexicon))])
    best = docs.select("doc_id", tokens("text").alias("_t")).withColumn("_b", F.array_max(counts))
    hits = F.greatest(F.coalesce("_b.hits", F.lit(0)), F.lit(0))
    return best.select("doc_id", F.when(hits > 0, F.col("_b.lang")).otherwise("und").alias("guess"), hits.cast("long").alias("hits"))


SIGNALS = ["n_chars", "n_words", "word_length", "symbol_share", "upper_share", "distinct_share", "repeated_line_share", "stop_word_share", "ended_line_share"]


def with_signals(docs: DataFrame) -> DataFrame:
    """``docs`` with the signals of each text, ``SIGNALS``, in one narrow pass; columns of these names are replaced."""
    share = lambda a, b: F.round(F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0)), 6)
    cut = docs.withColumns({"_w": pieces("text"), "_l": F.filter(F.split("text", "\n"), lambda s: F.trim(s) != "")})
    common = sorted({w for words in STOP_WORDS.values() for w in words})
    n, lines = F.size("_w"), F.size("_l")
    letters = F.length(F.array_join("_w", ""))
    return cut.withColumns(dict(zip(SIGNALS, [
        F.length("text").cast("long"), n.cast("long"), share(letters, n),
        share(F.regexp_count("text", F.lit(SYMBOLS)), n),
        share(F.regexp_count("text", F.lit(r"\p{Lu}")), F.regexp_count("text", F.lit(r"\p{L}"))),
        share(F.size(F.array_distinct("_w")), n),
        share(lines - F.size(F.array_distinct("_l")), lines),
        share(F.size(F.filter("_w", lambda w: F.lower(w).isin(common))), n),
        share(F.size(F.filter("_l", lambda s: F.regexp_like(s, F.lit(LINE_STOPS)))), lines),
    ]))).drop("_w", "_l")


def doc_stats(docs: DataFrame) -> DataFrame:
    """Signals of each text: counts, mean word length, and shares of symbols, capitals, distinct words,
    repeated lines, stop words and lines that end a sentence."""
    return with_signals(docs).select("doc_id", *SIGNALS)


def top_terms(docs: DataFrame, k: int = 20, by: str = "lang") -> DataFrame:
    """The ``k`` most frequent terms per value of ``by`` with their share of all its tokens.

    Counts are partly summed before the shuffle and ranked in two steps.
    """
    counts = unnest(docs, [by], tokens("text"), "term").groupBy(by, "term").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(by).agg(F.sum("n").alias("_all"))
    best = top_k(counts.withColumn("score", F.col("n")), [by], k, ["term"])
    return best.join(broadcast_if(totals), by).select(by, "term", "n", F.round(F.col("n") / F.col("_all"), 6).alias("share"), "rank")


def split_by_hash(docs: DataFrame, ratios: dict[str, int], key: str = "doc_id") -> DataFrame:
    """``docs`` with ``split``: parts of whole percents named in ``ratios``, decided by the key alone."""
    if sum(ratios.values()) != 100:
        raise ValueError("the parts must add up to 100")
    at, low, out = F.pmod(hash28(F.col(key).cast("string")), F.lit(100)), 0, None
    for name, share in ratios.items():
        inside = (at >= low) & (at < low + share)
        out = F.when(inside, name) if out is None else out.when(inside, name)
        low += share
    return docs.withColumn("split", out)


def dialogue_pairs(turns: DataFrame, context: int | None = None) -> DataFrame:
    """``conv_id, turn, prompt, response, context``: user turns with the assistant turn that follows.

    ``context`` holds all turns before, ``role: text`` each, or the last ``context`` of them if
    given; turns are numbered from 0. Turns meet on (dialogue, turn), so a long dialogue
    spreads over many tasks, though its full contexts grow with its square; user turns
    without an answer are left out.
    """
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    answers = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    pairs = asked.join(answers, ["conv_id", "turn"])
    said = turns.select("conv_id", F.col("turn").alias("before"), F.concat("role", F.lit(": "), "text").alias("line"))
    low = F.lit(0).cast("long") if context is None else F.greatest(F.lit(0), F.col("turn") - context)
    wanted = pairs.filter(F.col("turn") > low).select("conv_id", "turn", F.explode(F.sequence(low, F.col("turn") - 1)).alias("before"))
    held = wanted.join(said, ["conv_id", "before"]).groupBy("conv_id", "turn").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("before", "line"))), lambda s: s["line"]), "\n").alias("context"))
    return pairs.join(held, ["conv_id", "turn"], "left").withColumn("context", F.coalesce("context", F.lit("")))


def funnel(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """Rows and characters after each stage and what the stage took away; one small row per stage."""
    counted = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars")).select(
            F.lit(i).alias("step"), F.lit(name).alias("stage"), "n_docs", "n_chars")
        for i, (name, df) in enumerate(stages)
    ])
    w = Window.orderBy("step")
    lost = lambda c: F.coalesce(F.lag(c).over(w) - F.col(c), F.lit(0)).alias(f"{c}_lost")
    return counted.select("step", "stage", "n_docs", "n_chars", lost("n_docs"), lost("n_chars"))
