"""SQL for DuckDB that must give the same rows as each query of the registry.

Written apart from the operators: relational SQL over whole tables, with none of
their shortcuts. Fixed values (patterns over markup, limits) are stated anew here; what
the two share by intent, such as which tags are furniture, is tested on planted pages.
"""

from __future__ import annotations

import math

SIZE, OVERLAP, SENTENCE_SIZE, DIM = 120, 20, 400, 256
K, DEPTH = 10, 50


def tok(x: str) -> str:
    return rf"list_filter(string_split_regex(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')"


def with_(ctes: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


# --- pages

_ARTICLES = r"array_to_string(regexp_extract_all(html, '(?is)<article[^>]*>(.*?)(?:</article>|\z)', 1), chr(10))"
_BODY = r"regexp_extract(html, '(?is)<body[^>]*>(.*?)(?:</body>|\z)', 1)"
_MAIN = rf"""CASE WHEN {_ARTICLES} <> '' THEN {_ARTICLES} WHEN {_BODY} <> '' THEN {_BODY}
  ELSE regexp_replace(html, '(?is)<head(?:\s[^>]*)?>.*?</head>', ' ') END"""


def _strip(x: str) -> str:
    for pattern in [r"<!--.*?(?:-->|\z)", r"<script[^>]*>.*?(?:</script>|\z)", r"<style[^>]*>.*?(?:</style>|\z)",
                    *(f"<{tag}[^>]*>.*?</{tag}>" for tag in ("nav", "header", "aside", "footer", "h1"))]:
        x = f"regexp_replace({x}, '(?is){pattern}', ' ', 'g')"
    block = r"(?i)</?(?:p|br|div|li|ul|ol|tr|table|h[1-6]|section|blockquote|pre)(?:\s[^>]*)?/?>"
    x = f"regexp_replace({x}, '{block}', chr(10), 'g')"
    x = f"regexp_replace({x}, '(?s)<[^>]*>', '', 'g')"
    return x


def _decode(x: str) -> str:
    for name, sign in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                       ("&apos;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]:
        x = f"replace({x}, '{name}', '{sign}')"
    return x


def _text() -> str:
    x = _decode(_strip(_MAIN))
    x = rf"regexp_replace({x}, '[ \t\r]+', ' ', 'g')"
    x = rf"regexp_replace({x}, ' ?\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace({x}, '^[ \n]+|[ \n]+$', '', 'g')"


_LANG = r"""coalesce(nullif(lower(regexp_extract(html, '(?i)<html[^>]*\slang=["'']?([a-z]+)', 1)), ''), 'und')"""
_HOST = r"lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)', 1))"
PAGE_DOCS = (
    f"page_docs AS (SELECT doc_id, text, lang, source, length(text)::BIGINT AS n_chars FROM "
    f"(SELECT page_id AS doc_id, {_text()} AS text, {_LANG} AS lang, {_HOST} AS source FROM pages))"
)


def _profile(table: str) -> str:
    return f"""SELECT lang, source, grouping(lang, source)::INT AS level, count(*) AS n_docs,
  sum(n_chars)::BIGINT AS n_chars_total, sum(len({tok('text')}))::BIGINT AS n_words_total,
  min(n_chars) AS chars_min, round(quantile_cont(n_chars, 0.5), 4) AS chars_p50,
  round(quantile_cont(n_chars, 0.9), 4) AS chars_p90, max(n_chars) AS chars_max
FROM {table} GROUP BY ROLLUP (lang, source)"""


# --- passages


def passages(name: str, table: str, size: int = SIZE, overlap: int = OVERLAP, extra: str = "lang, source") -> str:
    extra = f"{extra}, " if extra else ""
    return rf"""{name} AS (
  SELECT doc_id, (s // {size - overlap})::INT AS chunk_no, {extra}s::INT AS start,
    array_to_string(w[s + 1 : s + {size}], ' ') AS chunk
  FROM (SELECT *, unnest(range(0, greatest(len(w) - {overlap} - 1, 0) + 1, {size - overlap})) AS s
    FROM (SELECT *, list_filter(string_split_regex(text, '[\s\p{{Z}}]+'), lambda t: t <> '') AS w FROM {table})
    WHERE len(w) > 0))"""


def sentence_passages(name: str, table: str, size: int = SENTENCE_SIZE, extra: str = "lang, source") -> str:
    extra = f"{extra}, " if extra else ""
    return rf"""{name}_s AS (
  SELECT doc_id, {extra}list_filter(list_transform(string_split_regex(regexp_replace(regexp_replace(text,
    '([.!?])[\s\p{{Z}}]+', '\1' || chr(10), 'g'), '([。！？])', '\1' || chr(10), 'g'), '\n+'),
    lambda s: trim(s, ' ')), lambda s: s <> '') AS s FROM {table}),
{name}_f AS (
  SELECT doc_id, {extra}list_reduce(list_transform(s, lambda x: {{'open': x, 'done': []::VARCHAR[]}}),
    lambda a, x: CASE WHEN length(a.open || ' ' || x.open) <= {size}
      THEN {{'open': a.open || ' ' || x.open, 'done': a.done}}
      ELSE {{'open': x.open, 'done': list_append(a.done, a.open)}} END) AS f
  FROM {name}_s WHERE len(s) > 0),
{name} AS (
  SELECT doc_id, (i - 1)::INT AS chunk_no, {extra}c[i] AS chunk
  FROM (SELECT *, unnest(range(1, len(c) + 1)) AS i FROM
    (SELECT doc_id, {extra}list_append(f.done, f.open) AS c FROM {name}_f)))"""


# --- ranking


def bm25_ctes(p: str, chunks: str, asked: str, k: int, by: str = "", where: str = "true") -> list[str]:
    g = f"{by}, " if by else ""
    join = f"JOIN {p}_tot USING ({by})" if by else f"CROSS JOIN {p}_tot"
    return [
        f"{p}_tok AS (SELECT *, {tok('chunk')} AS t FROM {chunks})",
        f"""{p}_post AS (SELECT {g}doc_id, chunk_no, term, count(*) AS tf, any_value(n) AS n_words,
  any_value(ok) AS ok FROM (SELECT {g}doc_id, chunk_no, unnest(t) AS term, len(t) AS n, {where} AS ok FROM {p}_tok)
  GROUP BY {g}doc_id, chunk_no, term)""",
        f"{p}_df AS (SELECT {g}term, count(*) AS df FROM {p}_post GROUP BY {g}term)",
        f"{p}_tot AS (SELECT {g}count(*) AS n, sum(len(t)) AS words FROM {p}_tok WHERE len(t) > 0 "
        + (f"GROUP BY {by})" if by else ")"),
        f"""{p}_q AS (SELECT query_id, term, count(*) AS qtf FROM
  (SELECT query_id, unnest({tok('question')}) AS term FROM {asked}) GROUP BY query_id, term)""",
        f"""{p}_score AS (SELECT {g}query_id, doc_id, chunk_no, round(sum(
  qtf * ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
  / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n_words / (words::DOUBLE / n)))), 6) AS score
  FROM {p}_post JOIN {p}_q USING (term) JOIN {p}_df USING ({g}term) {join} WHERE ok
  GROUP BY {g}query_id, doc_id, chunk_no)""",
        f"""{p} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {g}query_id
  ORDER BY score DESC, doc_id, chunk_no) AS rank FROM {p}_score) WHERE rank <= {k})""",
    ]


def hash_ctes(p: str, source: str, keys: str, text: str, idf: str | None = None) -> list[str]:
    """Unit vectors as rows; ``idf`` names another prefix whose weights to use."""
    w = idf or p
    out = [
        f"""{p}_tf AS (SELECT {keys}, b, count(*) AS tf FROM (SELECT {keys},
  unnest(list_transform({tok(text)}, lambda t: ('0x' || substr(md5(t), 1, 7))::BIGINT % {DIM})) AS b FROM {source})
  GROUP BY {keys}, b)""",
    ]
    if idf is None:
        out += [
            f"{p}_df AS (SELECT b, count(*) AS df FROM {p}_tf GROUP BY b)",
            f"{p}_n AS (SELECT count(*) AS n FROM {source})",
        ]
    out += [
        f"""{p}_raw AS (SELECT {keys}, b, tf * (ln((n + 1)::DOUBLE / (coalesce(df, 0) + 1)) + 1) AS x
  FROM {p}_tf LEFT JOIN {w}_df USING (b) CROSS JOIN {w}_n)""",
        f"{p} AS (SELECT {keys}, b, x / sqrt(sum(x * x) OVER (PARTITION BY {keys})) AS x FROM {p}_raw)",
    ]
    return out


def near_ctes(k: int) -> list[str]:
    return [
        *hash_ctes("hv", "chunks", "doc_id, chunk_no", "chunk"),
        *hash_ctes("hq", "asked", "query_id", "question", "hv"),
        """near_score AS (SELECT query_id, doc_id, chunk_no, round(sum(hv.x * hq.x), 6) AS score
  FROM hv JOIN hq USING (b) GROUP BY query_id, doc_id, chunk_no)""",
        f"""near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id
  ORDER BY score DESC, doc_id, chunk_no) AS rank FROM near_score) WHERE rank <= {k})""",
    ]


def best_ctes(p: str, hits: str, by: str = "") -> list[str]:
    g = f"{by}, " if by else ""
    return [
        f"""{p}_b AS (SELECT * FROM (SELECT {g}query_id, doc_id, chunk_no, score, row_number() OVER
  (PARTITION BY {g}query_id, doc_id ORDER BY score DESC, chunk_no) AS r FROM {hits}) WHERE r = 1)""",
        f"""{p} AS (SELECT {g}query_id, doc_id, chunk_no, score, row_number() OVER
  (PARTITION BY {g}query_id ORDER BY score DESC, doc_id) AS rank FROM {p}_b)""",
    ]


def vector_sql(score: str, where: str = "true") -> str:
    return f"""WITH cells AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT label, pos, round(avg(x::DOUBLE), 6) AS x FROM cells GROUP BY label, pos),
centroids AS (SELECT label::BIGINT AS query_id, list(x ORDER BY pos) AS q FROM means GROUP BY label),
scored AS (SELECT query_id, vec_id, round({score}, 6) AS score FROM
  (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE {where}), centroids)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= {K}"""


COSINE = "list_cosine_similarity(v, q)"


def ivf_sql(cells: int, probes: int, rounds: int = 3) -> str:
    """Cells by rounds of averaging directions, then exact cosines within the probed cells."""
    unit = lambda v: f"list_transform({v}, lambda x: x / sqrt(list_dot_product({v}, {v})))"
    near = lambda v, c: f"round(list_dot_product({v}, {c}) / sqrt(list_dot_product({c}, {c})), 6)"
    ctes = [
        f"vecs AS (SELECT vec_id, v, {unit('v')} AS u FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings))",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY h, vec_id) - 1 AS cell, list_transform(u, lambda x: round(x, 6)) AS c FROM
  (SELECT *, ('0x' || substr(md5(vec_id::VARCHAR), 1, 7))::BIGINT AS h FROM vecs ORDER BY h, vec_id LIMIT {cells}))""",
    ]
    placed = lambda k, name, source, key, u, n: f"""{name} AS (SELECT {key}, cell FROM (SELECT {key}, cell,
  row_number() OVER (PARTITION BY {key} ORDER BY {near(u, 'c')} DESC, cell) AS r FROM {source}, c{k}) WHERE r <= {n})"""  # noqa: E731
    for k in range(rounds):
        ctes += [
            placed(k, f"p{k}", "vecs", "vec_id", "u", 1),
            f"""m{k} AS (SELECT cell, pos, round(avg(x), 6) AS x FROM (SELECT cell, unnest(u) AS x, generate_subscripts(u, 1) AS pos
  FROM vecs JOIN p{k} USING (vec_id)) GROUP BY cell, pos)""",
            f"""c{k + 1} AS (SELECT cell, coalesce(n, c) AS c FROM c{k} LEFT JOIN
  (SELECT cell, list(x ORDER BY pos) AS n FROM m{k} GROUP BY cell) USING (cell))""",
        ]
    ctes += [
        placed(rounds, "home", "vecs", "vec_id", "u", 1),
        "cells AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)",
        "means AS (SELECT label, pos, round(avg(x::DOUBLE), 6) AS x FROM cells GROUP BY label, pos)",
        "centroids AS (SELECT label::BIGINT AS query_id, list(x ORDER BY pos) AS q FROM means GROUP BY label)",
        f"asking AS (SELECT query_id, q, {unit('q')} AS qu FROM centroids)",
        placed(rounds, "probed", "asking", "query_id", "qu", probes),
        f"""scored AS (SELECT query_id, vec_id, round({COSINE}, 6) AS score FROM asking JOIN probed USING (query_id)
  JOIN home USING (cell) JOIN vecs USING (vec_id))""",
    ]
    return with_(ctes, f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
FROM scored) WHERE rank <= {K}""")


ASKED = "asked AS (SELECT item_id AS query_id, text AS question FROM benchmark)"
CHUNKS = passages("chunks", "documents")
QRELS = f"""qrels AS (SELECT DISTINCT i.query_id, d.doc_id, 1 AS rel FROM
  (SELECT item_id AS query_id, ' ' || array_to_string({tok('text')}, ' ') || ' ' AS t FROM benchmark) i
  JOIN (SELECT doc_id, ' ' || array_to_string({tok('text')}, ' ') || ' ' AS t FROM documents) d ON contains(d.t, i.t))"""
JUDGED = "judged AS (SELECT query_id, count(*) AS n_rel FROM qrels GROUP BY query_id)"
BASE = [ASKED, CHUNKS]
RUN_A = [*bm25_ctes("lex", "chunks", "asked", DEPTH), *best_ctes("run_a", "lex")]
RUN_B = [*near_ctes(DEPTH), *best_ctes("run_b", "near")]
HITS = "SELECT query_id, doc_id, chunk_no, score, rank FROM"


def recall_select(run: str, ks: list[int], by: str = "") -> str:
    g = f"{by}, " if by else ""
    return f"""SELECT {g}k::INT AS k, round(sum(h / n_rel) / any_value(nq), 6) AS recall,
  round(sum(h / k) / any_value(nq), 6) AS precision,
  round(sum(CASE WHEN h > 0 THEN 1.0::DOUBLE ELSE 0 END) / any_value(nq), 6) AS hit_rate, any_value(nq) AS n_queries
FROM (SELECT {g}r.query_id, k, count(*) FILTER (WHERE rank <= k AND q.rel > 0)::DOUBLE AS h
    FROM {run} r CROSS JOIN (SELECT unnest({ks}) AS k) LEFT JOIN qrels q
    ON q.query_id = r.query_id AND q.doc_id = r.doc_id GROUP BY {g}r.query_id, k)
  JOIN judged USING (query_id) CROSS JOIN (SELECT count(*) AS nq FROM judged) GROUP BY {g}k"""


def ndcg_ctes(p: str, run: str) -> list[str]:
    return [
        f"""{p} AS (SELECT j.query_id, round(coalesce(got, 0) / ideal, 6) AS ndcg FROM
  (SELECT query_id, sum(1 / log2(i + 1)) AS ideal FROM (SELECT query_id,
     row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS i FROM qrels) WHERE i <= {K} GROUP BY query_id) j
  LEFT JOIN (SELECT r.query_id, sum(1 / log2(rank + 1)) AS got FROM {run} r JOIN qrels q
     ON q.query_id = r.query_id AND q.doc_id = r.doc_id WHERE rank <= {K} GROUP BY r.query_id) g USING (query_id))"""
    ]


# --- question sets

QA = """qa AS (SELECT u.conv_id::VARCHAR AS title, a.text AS context, u.conv_id || '-' || u.turn AS id,
  u.text AS question FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
GOLD = """gold AS (SELECT DISTINCT id, gold FROM
  (SELECT id, unnest(string_split(context, chr(10))) AS gold FROM qa) WHERE gold <> '')"""
REPLIES = "replies AS (SELECT conv_id * 1000000 + turn AS doc_id, text FROM conversations WHERE role = 'assistant')"
QA_BASE = [
    QA, GOLD, REPLIES, sentence_passages("reply_chunks", "replies", extra=""),
    "qa_asked AS (SELECT id AS query_id, question FROM qa)",
]
ANSWERS = [
    *QA_BASE, *bm25_ctes("qa_lex", "reply_chunks", "qa_asked", 1),
    "pred AS (SELECT query_id AS id, chunk AS answer FROM qa_lex JOIN reply_chunks USING (doc_id, chunk_no))",
]


def norm(x: str, unit: str = "word") -> str:
    gap = "" if unit == "char" else " "
    return rf"trim(regexp_replace(regexp_replace(lower({x}), '[\p{{P}}\p{{S}}]+', '', 'g'), '[\s\p{{Z}}]+', '{gap}', 'g'), ' ')"


def f1_sql(unit: str) -> str:
    def cut(x):
        if unit == "char":
            return rf"regexp_extract_all(lower({norm(x, unit)}), '[^\s\p{{Z}}]', 0)"
        return tok(norm(x, unit))

    return with_(
        [
            *ANSWERS,
            "pairs AS (SELECT row_number() OVER () AS pair, id, answer, gold FROM gold LEFT JOIN pred USING (id))",
            f"pt AS (SELECT pair, id, {cut('answer')} AS a, {cut('gold')} AS g FROM pairs)",
            "ac AS (SELECT pair, x, count(*) AS n FROM (SELECT pair, unnest(a) AS x FROM pt) GROUP BY pair, x)",
            "gc AS (SELECT pair, x, count(*) AS n FROM (SELECT pair, unnest(g) AS x FROM pt) GROUP BY pair, x)",
            "shared AS (SELECT pair, sum(least(ac.n, gc.n)) AS s FROM ac JOIN gc USING (pair, x) GROUP BY pair)",
        ],
        """SELECT id, round(max(CASE WHEN a IS NULL THEN 0 WHEN len(a) + len(g) = 0 THEN 1.0::DOUBLE
  ELSE 2.0::DOUBLE * coalesce(s, 0) / (len(a) + len(g)) END), 6) AS f1
FROM pt LEFT JOIN shared USING (pair) GROUP BY id""",
    )


# Draws of 13 and more have a probability below that of one 28-bit hash.
_POISSON = [sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(13)]
_WEIGHT = " + ".join(f"(u >= {p}::DOUBLE)::INT" for p in _POISSON)

_REFRESHED = f"""fresh AS (SELECT d.doc_id, CASE WHEN toxic = 1 THEN text || ' revised' ELSE text END AS text
  FROM documents d LEFT JOIN labels l USING (doc_id) WHERE quality IS NULL OR quality = 1
  UNION ALL SELECT -1 - doc_id, text FROM page_docs)"""

_CONTEXT = """ctx_w AS (SELECT query_id, doc_id, n AS chunk_no, min(rank) AS rank FROM
  (SELECT query_id, doc_id, rank, unnest(range(chunk_no - {w}, chunk_no + {w} + 1)) AS n FROM {hits}) GROUP BY ALL),
ctx_h AS (SELECT w.*, c.chunk FROM ctx_w w JOIN {chunks} c ON c.doc_id = w.doc_id AND c.chunk_no = w.chunk_no),
ctx_n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, doc_id, chunk_no) AS r FROM ctx_h),
ctx_f AS (SELECT query_id, 0::BIGINT AS r, 0::BIGINT AS used, '' AS context, 0 AS n FROM {queries}
  UNION ALL SELECT f.query_id, h.r, CASE WHEN ok THEN size ELSE used END,
    CASE WHEN NOT ok THEN context WHEN n = 0 THEN chunk ELSE context || chr(10) || chr(10) || chunk END,
    n + ok::INT FROM ctx_f f JOIN ctx_n h ON h.query_id = f.query_id AND h.r = f.r + 1,
    LATERAL (SELECT used + length(chunk) + CASE WHEN n > 0 THEN 2 ELSE 0 END AS size) s,
    LATERAL (SELECT size <= 2000 AS ok) o),
ctx AS (SELECT query_id, n::BIGINT AS n_passages, r - n AS n_skipped, used AS n_chars, context FROM ctx_f
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY r DESC) = 1)"""


def _sweep() -> str:
    parts, names = [], []
    for size, overlap in [(60, 0), (120, 20), (240, 40)]:
        name = f"c{size}"
        parts.append(passages(name, "documents", size, overlap, ""))
        names.append(f"SELECT doc_id, chunk_no, chunk, {size} AS size, {overlap} AS overlap FROM {name}")
    by = "size, overlap"
    return with_(
        [ASKED, *parts, f"all_chunks AS ({' UNION ALL '.join(names)})",
         *bm25_ctes("lex", "all_chunks", "asked", DEPTH, by), *best_ctes("run_s", "lex", by), QRELS, JUDGED],
        recall_select("run_s", [1, 10], by),
    )


# --- preparation

_PATH = r"regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_CANON = rf"""canon AS (SELECT page_id, regexp_replace({_HOST}, '^(?:www|m|blog)\.', '') AS host,
  regexp_replace({_PATH}, '(?:/index)?(?:\.html?)?/*$', '') AS path FROM pages)"""
_LINKS = rf"""hrefs AS (SELECT page_id, {_HOST} AS source, regexp_replace(unnest(regexp_extract_all(html,
  '(?i)<a\s[^>]*?href\s*=\s*["'']?([^"''\s>]+)', 1)), '#.*$', '') AS url FROM pages),
links AS (SELECT page_id, source, regexp_replace(CASE WHEN contains(url, '://') THEN {_HOST} || {_PATH}
  WHEN starts_with(url, '/') THEN source || url END, '/+$', '') AS target FROM hrefs)"""
_STOP = {
    "de": "der die und das den nicht mit ist von im sich auf", "en": "the of and to in is that it for was with are",
    "es": "el los las y una por con para su lo como del", "fr": "le les et des est dans pour pas au sur avec ou",
}
_LEXICON = "lexicon AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{lang}', '{w}')" for lang, words in _STOP.items() for w in words.split()) + ") AS t(lang, term))"
_GUESS = f"""guess AS (SELECT doc_id, coalesce(arg_min(l, (-n, l)), 'und') AS guess, coalesce(max(n), 0) AS hits FROM documents LEFT JOIN
  (SELECT doc_id, lexicon.lang AS l, count(*) AS n FROM (SELECT doc_id, unnest({tok('text')}) AS term FROM documents)
   JOIN lexicon USING (term) GROUP BY ALL) USING (doc_id) GROUP BY doc_id)"""
_SPLIT = """CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 7))::BIGINT % 100 < 90 THEN 'train'
  WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 7))::BIGINT % 100 < 95 THEN 'valid' ELSE 'test' END"""


def _share(a: str, b: str) -> str:
    return f"round(CASE WHEN {b} = 0 THEN 0 ELSE ({a})::DOUBLE / ({b}) END, 6)"


def _stats(table: str = "documents") -> str:
    stop = ", ".join(f"'{w}'" for words in _STOP.values() for w in words.split())
    n = lambda p: f"len(regexp_extract_all(text, '{p}'))"
    return rf"""SELECT doc_id, length(text)::BIGINT AS n_chars, len(w)::BIGINT AS n_words,
  {_share("length(array_to_string(w, ''))", "len(w)")} AS word_length, {_share(n("[#*$%&|<>]"), "len(w)")} AS symbol_share,
  {_share(n(chr(92) + "p{Lu}"), n(chr(92) + "p{L}"))} AS upper_share, {_share("len(list_distinct(w))", "len(w)")} AS distinct_share,
  {_share("len(l) - len(list_distinct(l))", "len(l)")} AS repeated_line_share,
  {_share(f"len(list_filter(w, lambda x: lower(x) IN ({stop})))", "len(w)")} AS stop_word_share,
  {_share(r"len(list_filter(l, lambda x: regexp_matches(x, '[.!?…][" + chr(34) + "'')»”]?" + chr(92) + "s*$')))", "len(l)")} AS ended_line_share
FROM (SELECT doc_id, text, list_filter(string_split_regex(text, '[\s\p{{Z}}]+'), lambda t: t <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda s: trim(s) <> '') AS l FROM {table})"""


_REASONS = """array_to_string(list_filter([CASE WHEN n_words < 20 THEN 'few words' END,
  CASE WHEN word_length < 2 OR word_length > 12 THEN 'odd word length' END, CASE WHEN symbol_share > 0.1 THEN 'symbols' END,
  CASE WHEN upper_share > 0.5 THEN 'capitals' END, CASE WHEN repeated_line_share > 0.3 THEN 'repeated lines' END,
  CASE WHEN ended_line_share < 0.2 THEN 'no sentence ends' END], lambda r: r IS NOT NULL), ', ')"""


def _curated() -> str:
    landing = "('0x' || substr(md5(doc_id::VARCHAR), 1, 7))::BIGINT % 2"
    return with_([
        PAGE_DOCS, _CANON, f"stats AS ({_stats('page_docs')})",
        f"""once AS (SELECT page_docs.*, row_number() OVER (PARTITION BY canon.host || path ORDER BY {landing}, doc_id) AS nth
  FROM page_docs JOIN canon ON page_id = doc_id WHERE canon.host <> '')""",
        f"""passed AS (SELECT once.*, row_number() OVER (PARTITION BY text ORDER BY {landing}, doc_id) AS place
  FROM once JOIN stats USING (doc_id) WHERE nth = 1 AND {_REASONS} = '')"""],
        "SELECT doc_id, text, lang, source, n_chars FROM passed WHERE place = 1")


# Kinds of personal data: name, pattern, and the test of a candidate ``v`` after ``b`` and before ``a``.
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {_DIGITS}[-i]::INT
  ELSE 2 * {_DIGITS}[-i]::INT - CASE WHEN {_DIGITS}[-i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_OCTETS = "list_filter(string_split(v, '.'), lambda o: o::INT > 255 OR (o <> '0' AND o[1] = '0'))"
_PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
     "strpos(v, '@') BETWEEN 2 AND 65 AND NOT contains(v, '.@') AND NOT regexp_matches(split_part(v, '@', 2), '(^|\\.)-|-(\\.|$)')"),
    ("secret", r"\b[0-9a-f]{32,128}\b", "length(v) IN (32, 40, 56, 64, 96, 128) AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]')"),
    ("card", r"\b[0-9](?:[ -]?[0-9]){12,18}\b", f"v[1] IN ('2', '3', '4', '5', '6') AND {_LUHN}"),
    ("ip", r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b", f"len({_OCTETS}) = 0 AND NOT regexp_matches(b, '[0-9]\\.$') AND NOT regexp_matches(a, '^\\.[0-9]')"),
    ("phone", r"(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}\b", f"length({_DIGITS}) BETWEEN 8 AND 15 AND NOT regexp_matches(b, '[0-9A-Za-z_.+-]$')"),
    ("number", r"\b[0-9]{13,19}\b", "true"),
]
_LENGTHS = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)::BIGINT"


def _pii() -> list[str]:
    """All candidates; then, three times, those win that no better one overlaps, and what they overlap goes."""
    parts = " UNION ALL ".join(
        f"""SELECT doc_id, {i} AS rank, '{name}' AS kind, e - length(v) AS s, e, v FROM (
  SELECT *, {_LENGTHS.format('pieces[1:i]')} + {_LENGTHS.format('found[1:i]')} AS e,
    {"regexp_replace(found[i], '^(?:.*" + chr(92) + "." + chr(92) + ".|" + chr(92) + ".)', '')" if name == 'email' else 'found[i]'} AS v,
    right(pieces[i], 2) AS b, pieces[i + 1][1:2] AS a
  FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS found,
    unnest(range(1, len(found) + 1)) AS i FROM documents)) WHERE {test}"""
        for i, (name, pattern, test) in enumerate(_PII))
    overlap = "x.doc_id = y.doc_id AND x.s < y.e AND y.s < x.e"
    better = "(x.s - x.e, x.s, x.rank) < (y.s - y.e, y.s, y.rank)"
    ctes = [f"alive0 AS MATERIALIZED ({parts})"]
    for k in range(3):
        ctes.append(f"won{k} AS MATERIALIZED (SELECT y.* FROM alive{k} y WHERE NOT EXISTS (SELECT 1 FROM alive{k} x WHERE {overlap} AND {better}))")
        ctes.append(f"alive{k + 1} AS MATERIALIZED (SELECT y.* FROM alive{k} y WHERE NOT EXISTS (SELECT 1 FROM won{k} x WHERE {overlap}))")
    return [*ctes, "pii AS (SELECT * FROM won0 UNION ALL SELECT * FROM won1 UNION ALL SELECT * FROM won2)"]


def _redaction() -> str:
    cuts = """cuts AS (SELECT doc_id, s, e, '[' || upper(kind) || ']' AS put, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS since FROM pii),
joined AS (SELECT doc_id, count(*) AS n, max(e) AS last, string_agg(substring(text, since::BIGINT + 1, (s - since)::BIGINT) || put, '' ORDER BY s) AS head
  FROM cuts JOIN documents USING (doc_id) GROUP BY doc_id)"""
    return with_([*_pii(), cuts], """SELECT doc_id, CASE WHEN n IS NULL THEN text ELSE head || substring(text, last::BIGINT + 1) END AS text,
  coalesce(n, 0) AS n_findings FROM documents LEFT JOIN joined USING (doc_id)""")


ORACLES: dict[str, str] = {
    "find_pii": with_(_pii(), "SELECT doc_id, kind, s AS start, e - s AS length, v AS value FROM pii"),
    "redact": _redaction(),
    "pii_report": with_(_pii(), """SELECT source, lang, kind, grouping(source, lang, kind)::INT AS level, count(*) AS n_findings,
  count(DISTINCT doc_id) AS n_docs FROM pii JOIN documents USING (doc_id) GROUP BY CUBE (source, lang, kind)"""),
    "read_qa_published": with_([QA, GOLD], "SELECT id, gold FROM qa JOIN gold USING (id)"),
    "canonical_urls": with_([_CANON], """SELECT host || path AS canon, host, path, min(page_id) AS page_id, count(*) AS n_pages
FROM canon WHERE host <> '' GROUP BY host, path"""),
    "apply_rules": f"SELECT doc_id, {_REASONS} AS reasons FROM ({_stats('(SELECT doc_id, coalesce(text, {}) AS text FROM documents)'.format(chr(39) * 2))})",
    "stream_curate": _curated(),
    "stream_counts": with_([f"""timed AS (SELECT {_HOST} AS host, 1704067200 + ('0x' || substr(md5('at' || page_id), 1, 7))::BIGINT % 86400 AS t,
  ('0x' || substr(md5('slow' || page_id), 1, 7))::BIGINT % 5 = 0 AS slow FROM pages)""",
        """landed AS (SELECT host, t, t // 3600 * 3600 AS start, CASE WHEN slow OR t >= 1704110400 THEN 1704153600 ELSE 1704110400 END AS landed FROM timed)""",
        "marked AS (SELECT *, start + 3600 + 7200 <= landed AS late FROM landed)"],
        """SELECT host, start, count(*) FILTER (WHERE NOT late) AS n, count(*) FILTER (WHERE late) AS n_late FROM marked
WHERE late OR start + 3600 <= (SELECT max(t) - 7200 FROM marked) GROUP BY host, start"""),
    "outlinks": with_([_LINKS], "SELECT * FROM links WHERE target <> ''"),
    "link_targets": with_([_LINKS], """SELECT target, count(*) AS n_links, count(DISTINCT page_id) AS n_pages FROM links
WHERE target <> '' GROUP BY target"""),
    "normalize_text": r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '\r\n?', chr(10), 'g'), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[ \t\x{A0}]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'),
  '\n{3,}', chr(10) || chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g') AS text FROM documents""",
    "drop_common_lines": with_([
        "lines AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))",
        "common AS (SELECT trim(line) AS t FROM lines WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT doc_id) >= 5)",
        """kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE t IS NULL) AS text, count(t) AS n_removed
  FROM lines LEFT JOIN common ON trim(line) = t GROUP BY doc_id)"""],
        """SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept USING (doc_id)"""),
    "detect_lang": with_([_LEXICON, _GUESS], "SELECT * FROM guess"),
    "doc_stats": _stats(),
    "threshold_sweep": with_([f"stats AS ({_stats()})", """counts AS (SELECT stop_word_share AS threshold, count(*) AS n,
  sum(quality) AS y FROM stats JOIN labels USING (doc_id) WHERE quality IS NOT NULL GROUP BY 1)""",
        "run AS (SELECT threshold, sum(n) OVER w AS n_kept, sum(y) OVER w AS n_right, sum(y) OVER () AS total FROM counts WINDOW w AS (ORDER BY threshold DESC))"],
        f"""SELECT threshold, n_kept::BIGINT AS n_kept, n_right::BIGINT AS n_right, {_share('n_right', 'n_kept')} AS precision, {_share('n_right', 'total')} AS recall,
  {_share('2 * n_right', '(n_kept + total)')} AS f1 FROM run"""),
    "top_terms": f"""WITH c AS (SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest({tok('text')}) AS term FROM documents) GROUP BY ALL)
SELECT * FROM (SELECT lang, term, n, round(n / (sum(n) OVER (PARTITION BY lang))::DOUBLE, 6) AS share,
  row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS rank FROM c) WHERE rank <= 20""",
    "split_by_hash": f"SELECT doc_id, {_SPLIT} AS split FROM documents",
    "mixture": r"""SELECT doc_id, lang FROM (SELECT doc_id, lang, CASE lang WHEN 'en' THEN 60000 WHEN 'de' THEN 25000 WHEN 'fr' THEN 10000
  WHEN 'es' THEN 1000000000000 END AS budget, sum(len(list_filter(string_split_regex(text, '[\s\p{Z}]+'), lambda t: t <> ''))) OVER (
  PARTITION BY lang ORDER BY ('0x' || substr(md5(doc_id::VARCHAR), 1, 7))::BIGINT, doc_id) AS upto FROM documents) WHERE upto <= budget""",
    "block_hosts": with_([_CANON, "listed AS (SELECT host FROM canon WHERE host <> '' GROUP BY host HAVING count(*) >= 5)"],
        f"""SELECT page_id, url FROM pages WHERE NOT EXISTS (SELECT 1 FROM listed WHERE {_HOST} = listed.host OR ends_with({_HOST}, '.' || listed.host))"""),
    "dialogue_pairs": """SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response, coalesce((SELECT string_agg(p.role || ': ' || p.text,
  chr(10) ORDER BY p.turn) FROM conversations p WHERE p.conv_id = u.conv_id AND p.turn < u.turn), '') AS context
FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""",
    "funnel": with_(
        [_LEXICON, _GUESS, f"""held AS (SELECT text, (guess = lang)::INT AS agrees, ({_SPLIT} = 'train')::INT AS part
  FROM documents JOIN guess USING (doc_id))""",
         """counted AS (SELECT 0 AS step, 'all' AS stage, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars FROM held
  UNION ALL SELECT 1, 'language agrees', count(*), coalesce(sum(length(text)), 0)::BIGINT FROM held WHERE agrees = 1
  UNION ALL SELECT 2, 'training part', count(*), coalesce(sum(length(text)), 0)::BIGINT FROM held WHERE agrees = 1 AND part = 1)"""],
        """SELECT *, coalesce(lag(n_docs) OVER (ORDER BY step) - n_docs, 0) AS n_docs_lost,
  coalesce(lag(n_chars) OVER (ORDER BY step) - n_chars, 0) AS n_chars_lost FROM counted"""),
    "read_pages": "SELECT page_id, url, html FROM pages",
    "extract_text": with_([PAGE_DOCS], "SELECT doc_id AS page_id, url, text FROM page_docs JOIN pages ON page_id = doc_id"),
    "page_meta": rf"""SELECT page_id, trim({_decode("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}) AS title,
  {_LANG} AS lang, {_HOST} AS host FROM pages""",
    "page_documents": with_([PAGE_DOCS], "SELECT * FROM page_docs"),
    "page_profile": with_([PAGE_DOCS], _profile("page_docs")),
    "corpus_profile": _profile("documents"),
    "write_corpus": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "write_corpus_json": with_([PAGE_DOCS], "SELECT * FROM page_docs"),
    "incremental_corpus": with_([PAGE_DOCS], "SELECT * FROM page_docs"),
    "read_qa": with_([QA, GOLD], """SELECT title, context, id, question, gold, instr(context, gold)::BIGINT - 1 AS answer_start
FROM qa JOIN gold USING (id)"""),
    "chunk": with_([CHUNKS], "SELECT doc_id, chunk_no, lang, source, start, chunk FROM chunks"),
    "chunk_chars": """SELECT doc_id, (s // 450)::INT AS chunk_no, lang, source, s::INT AS start, substr(text, s + 1, 500) AS chunk
FROM (SELECT *, unnest(range(0, greatest(length(text) - 51, 0) + 1, 450)) AS s FROM documents WHERE length(text) > 0)""",
    "chunk_sentences": with_([sentence_passages("sc", "documents")], "SELECT doc_id, chunk_no, lang, source, chunk FROM sc"),
    "index_postings": with_([*BASE, *bm25_ctes("lex", "chunks", "asked", K)],
                            "SELECT doc_id, chunk_no, term, tf, n_words FROM lex_post"),
    "index_terms": with_([*BASE, *bm25_ctes("lex", "chunks", "asked", K)], "SELECT term, df FROM lex_df"),
    "index_changes": with_([PAGE_DOCS, _REFRESHED], """SELECT doc_id, CASE WHEN d.text IS NULL THEN 'new'
  WHEN f.text IS NULL THEN 'deleted' WHEN d.text <> f.text THEN 'changed' ELSE 'same' END AS status
FROM documents d FULL OUTER JOIN fresh f USING (doc_id)"""),
    "update_index": with_(
        [PAGE_DOCS, _REFRESHED, passages("fc", "fresh", extra=""), ASKED, *bm25_ctes("lex", "fc", "asked", K)],
        """SELECT term, df, n_postings, n_tokens FROM lex_df JOIN
  (SELECT term, count(*) AS n_postings, sum(tf)::BIGINT AS n_tokens FROM lex_post GROUP BY term) USING (term)"""),
    "bm25": with_([*BASE, *bm25_ctes("lex", "chunks", "asked", K)], f"{HITS} lex"),
    "filtered_topk": with_([*BASE, *bm25_ctes("lex", "chunks", "asked", K, where="lang = 'en'")], f"{HITS} lex"),
    "hash_embed": with_([*BASE, *hash_ctes("hv", "chunks", "doc_id, chunk_no", "chunk")],
                        "SELECT doc_id, chunk_no, b::INT AS bucket, round(x, 6) AS weight FROM hv"),
    "vector_topk_cosine": vector_sql(COSINE),
    "vector_topk_dot": vector_sql("list_dot_product(v, q)"),
    "vector_topk_l2": vector_sql("-list_distance(v, q)"),
    "vector_filtered": vector_sql(COSINE, "label >= 5"),
    "semantic_dedup": """WITH u AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u
  FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings))
SELECT a.vec_id, count(b.vec_id) AS n_links, least(a.vec_id, min(b.vec_id)) AS first, coalesce(min(b.vec_id) > a.vec_id, true) AS kept
FROM u a LEFT JOIN u b ON a.vec_id <> b.vec_id AND round(list_dot_product(a.u, b.u), 6) >= 0.4 GROUP BY a.vec_id""",
    "vector_passages": with_([*BASE, *near_ctes(K)], f"{HITS} near"),
    "ivf_topk": ivf_sql(16, 4),
    "cell_search": ivf_sql(16, 4),
    "ivf_topk_all_cells": vector_sql(COSINE),
    "rrf": with_(
        [*BASE, *bm25_ctes("lex", "chunks", "asked", DEPTH), *near_ctes(DEPTH),
         "pooled AS (SELECT query_id, doc_id, chunk_no, rank FROM lex UNION ALL SELECT query_id, doc_id, chunk_no, rank FROM near)",
         "fused AS (SELECT query_id, doc_id, chunk_no, round(sum(1 / (60 + rank)::DOUBLE), 9) AS score FROM pooled GROUP BY ALL)"],
        f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_no) AS rank
FROM fused) WHERE rank <= {K}"""),
    "expand": with_([*BASE, *bm25_ctes("lex", "chunks", "asked", K), _CONTEXT.format(w=1, hits="lex", chunks="chunks", queries="asked")],
                    "SELECT query_id, doc_id, chunk_no, rank, chunk FROM ctx_h"),
    "best_per_doc": with_([*BASE, *RUN_A], f"{HITS} run_a"),
    "context": with_([*BASE, *bm25_ctes("lex", "chunks", "asked", K), _CONTEXT.format(w=1, hits="lex", chunks="chunks", queries="asked")],
                     "SELECT * FROM ctx"),
    "qrels": with_([QRELS], "SELECT * FROM qrels"),
    "recall_at": with_([*BASE, *RUN_A, QRELS, JUDGED], recall_select("run_a", [1, 3, 5, 10])),
    "mrr": with_([*BASE, *RUN_A, QRELS, JUDGED], """SELECT round(coalesce(sum(1 / r::DOUBLE), 0) / any_value(nq), 6) AS mrr,
  any_value(nq) AS n_queries FROM (SELECT count(*) AS nq FROM judged) LEFT JOIN
  (SELECT a.query_id, min(rank) AS r FROM run_a a JOIN qrels q ON q.query_id = a.query_id AND q.doc_id = a.doc_id
   GROUP BY a.query_id) ON true"""),
    "ndcg": with_([*BASE, *RUN_B, QRELS, *ndcg_ctes("nd", "run_b")],
                  f"SELECT {K} AS k, round(avg(ndcg), 6) AS ndcg, count(*) AS n_queries FROM nd"),
    "metric_report": with_(
        [*BASE, *RUN_B, QRELS, JUDGED, *ndcg_ctes("nd", "run_b"),
         f"""pq AS (SELECT query_id, round(coalesce(h, 0) / n_rel::DOUBLE, 6) AS recall,
  round(coalesce(1 / r::DOUBLE, 0), 6) AS rr, ndcg FROM judged JOIN nd USING (query_id) LEFT JOIN
  (SELECT b.query_id, count(*) FILTER (WHERE rank <= {K}) AS h, min(rank) AS r FROM run_b b JOIN qrels q
   ON q.query_id = b.query_id AND q.doc_id = b.doc_id GROUP BY b.query_id) USING (query_id))""",
         """sliced AS (SELECT pq.*, lang, source FROM pq JOIN (SELECT query_id, min(doc_id) AS doc_id FROM qrels
  GROUP BY query_id) USING (query_id) JOIN documents USING (doc_id))""",
         """cubed AS (SELECT CASE WHEN grouping(lang) = 1 THEN 'all' ELSE lang END AS lang,
  CASE WHEN grouping(source) = 1 THEN 'all' ELSE source END AS source, round(avg(recall), 6) AS recall,
  round(avg(rr), 6) AS rr, round(avg(ndcg), 6) AS ndcg, count(*) AS n FROM sliced GROUP BY CUBE (lang, source))"""],
        """SELECT lang, source, 'recall' AS metric, recall AS value, n FROM cubed
UNION ALL SELECT lang, source, 'rr', rr, n FROM cubed UNION ALL SELECT lang, source, 'ndcg', ndcg, n FROM cubed"""),
    "compare_systems": with_(
        [*BASE, *RUN_A, *RUN_B, QRELS, *ndcg_ctes("na", "run_a"), *ndcg_ctes("nb", "run_b"),
         "delta AS (SELECT query_id, round(coalesce(na.ndcg, 0) - coalesce(nb.ndcg, 0), 6) AS d FROM nb FULL OUTER JOIN na USING (query_id))",
         """drawn AS (SELECT r, d, ('0x' || substr(md5(query_id || '-' || r), 1, 7))::BIGINT / 268435456.0::DOUBLE AS u
  FROM delta CROSS JOIN (SELECT unnest(range(0, 200)) AS r))""",
         f"""means AS (SELECT r, round(sum(w * d) / nullif(sum(w), 0), 9) AS m FROM (SELECT r, d, {_WEIGHT} AS w FROM drawn) GROUP BY r)"""],
        """SELECT count(*) AS n_queries, round(avg(d), 6) AS mean_delta, count(*) FILTER (WHERE d > 0) AS wins,
  count(*) FILTER (WHERE d = 0) AS ties, count(*) FILTER (WHERE d < 0) AS losses,
  (SELECT round(quantile_cont(m, 0.025), 6) FROM means) AS low, (SELECT round(quantile_cont(m, 0.975), 6) FROM means) AS high
FROM delta"""),
    "sweep": _sweep(),
    "rank_diff": with_([*BASE, *RUN_A, *RUN_B], f"""SELECT query_id, doc_id, a.rank AS rank_a, b.rank AS rank_b,
  CASE WHEN b.rank IS NULL THEN 'only_a' WHEN a.rank IS NULL THEN 'only_b' ELSE 'both' END AS found
FROM (SELECT * FROM run_a WHERE rank <= {K}) a FULL OUTER JOIN (SELECT * FROM run_b WHERE rank <= {K}) b USING (query_id, doc_id)"""),
    "exact_match": with_(ANSWERS, f"""SELECT id, max(CASE WHEN {norm('answer')} = {norm('gold')} THEN 1 ELSE 0 END) AS em
FROM gold LEFT JOIN pred USING (id) GROUP BY id"""),
    "answer_f1": f1_sql("word"),
    "answer_f1_chars": f1_sql("char"),
    "support": with_(
        [*QA_BASE, *bm25_ctes("qa_lex", "reply_chunks", "qa_asked", 5), _CONTEXT.format(w=0, hits="qa_lex", chunks="reply_chunks", queries="qa_asked")],
        f"""SELECT id, round(CASE WHEN len(p) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(p, c)) / len(p)::DOUBLE END, 6) AS support
FROM (SELECT qa.id, list_distinct({tok('qa.context')}) AS p, list_distinct({tok("coalesce(ctx.context, '')")}) AS c
  FROM qa LEFT JOIN ctx ON ctx.query_id = qa.id)"""),
}
