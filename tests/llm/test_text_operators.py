"""Operators on texts against brute force on small tables."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from passagecraft.llm import byte_cnn, components, latent_search, licence_scan, line_dedup, order_minhash, packing, quality_rules, substring_dedup
from passagecraft.llm.known_licences import BSD_DISCLAIMER, BSD_HEAD, MIT
from passagecraft.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIDDLE = "/root/testdata/sf0.01"


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _components(nodes, links):
    owner = {x: x for x in nodes}

    def root(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        owner[b] = a
    return {x: root(x) for x in nodes}


# --- components and lines


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(60)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7), (500, 500)]
    got = components.components(spark.createDataFrame([*links, (None, 1)], "a long, b long"))
    nodes = {x for link in links for x in link}
    assert dict(rows(got, "id", "root")) == _components(nodes, links)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_bit_parallel_distance(spark, distance):
    rng = random.Random(distance)
    pairs = [("", ""), ("", "a"), ("ab", "")]
    for _ in range(150):
        a = "".join(rng.choices("ab", k=rng.randint(0, 8)))
        b = list(a)
        for _ in range(rng.randint(0, distance + 1)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "é"])
        pairs.append((a, "".join(b)))
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", line_dedup.within_distance(F.col("a"), F.col("b"), distance).alias("near"))
    assert all(r.near == (_edits(r.a, r.b) <= distance) for r in got.collect())


@pytest.mark.parametrize(("distance", "hot"), [(1, 10**6), (2, 10**6), (1, 1)])
def test_near_lines(spark, distance, hot):
    rng = random.Random(5)
    lines = set()
    for _ in range(25):
        base = "".join(rng.choices("abc", k=rng.randint(6, 10)))
        lines.add(base)
        for _ in range(4):
            b = list(base)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(b))
                b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "d"])
            lines.add("".join(b) or "a")
    lines = sorted(lines)
    named = {(r.h1, r.h2): r.text for r in _docs(spark, lines).select("text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(7), "text").alias("h2")).collect()}
    got = {tuple(sorted((named[tuple(r.a)], named[tuple(r.b)]))) for r in line_dedup.near_lines(_docs(spark, lines), distance, 1, hot).collect()}
    want = {(a, b) for a in lines for b in lines if a < b and _edits(a, b) <= distance}
    assert got <= want and _components(lines, got) == _components(lines, want)
    assert hot == 1 or got == want


# --- packing


def test_tokens_and_places(spark):
    from tokenizers import Tokenizer

    path = tokenizer_path()
    whole = Tokenizer.from_file(path)
    odd = ["Ünïcode ÀÉ e\u0301 \u0301x", "a<|endoftext|>b <|startoftext|>", "it's we'll\tx\u00a0y\u2028z", "1234 ٣٤ 你好 😀", "", None, " ", "ΑΣ ΟΔΟΣ", "x" * 3000, "a\u0000b"]
    rng = random.Random(3)
    texts = odd + [" ".join("w" + str(rng.randint(0, 10**rng.randint(1, 6))) for _ in range(rng.choice([3, 40, 700, 2500]))) for _ in range(60)]
    got = packing.pack(_docs(spark, texts), path, with_ids=True).collect()
    pieces, places = {}, {}
    for r in got:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        pieces[r.doc_id, r.piece] = r
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in enumerate(texts):
        want = whole.encode(text or "", add_special_tokens=False).ids + [0]
        held, n = [], 0
        while (i, n) in pieces:
            assert pieces[i, n].start == len(held) and (n == 0 or pieces[i, n - 1].length == 2048)
            held += pieces[i, n].ids
            n += 1
        assert held == want
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) == -(-sum(r.length for r in got) // 2048)


def _fewest(sizes, capacity):
    """Exact number of bins, over all subsets."""
    best = [(0, 0)] + [(99, 0)] * (2 ** len(sizes) - 1)
    for done in range(1, 2 ** len(sizes)):
        for i, s in enumerate(sizes):
            if done >> i & 1:
                bins, room = best[done ^ (1 << i)]
                best[done] = min(best[done], (bins, -(-room + s)) if room >= s else (bins + 1, -(capacity - s)), key=lambda x: (x[0], -abs(x[1])))
                best[done] = best[done][0], abs(best[done][1])
    return best[-1][0]


def test_bin_completion_is_as_good_as_exact_search():
    from collections import Counter

    rng = random.Random(7)
    for _ in range(60):
        sizes = [rng.randint(2, 16) for _ in range(rng.randint(1, 9))]
        plan = packing.complete(Counter(sizes), 20)
        assert sum((Counter({s: n * times for s, n in Counter(p).items()}) for p, times in plan), Counter()) == Counter(sizes)
        assert all(sum(p) <= 20 for p, _ in plan)
        assert sum(times for _, times in plan) == _fewest(sizes, 20)


def test_search_beats_best_fit():
    from collections import Counter

    counts = Counter({7: 2, 6: 2, 5: 2, 4: 3, 3: 4})
    assert sum(t for _, t in packing.complete(counts, 20)) == 3
    many = Counter({s: 1000 + s % 7 for s in range(100, 2049, 13)})
    plan = packing.complete(many)
    assert sum(t for _, t in plan) <= packing.best_fit(many, 2048)[1] and len(plan) < 20_000


# --- substrings


def test_sketch_loses_nothing(spark, monkeypatch):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(6)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(60)]
    texts += [t + "  " + texts[0] for t in texts[:5]] + texts[:3] + ["a b " * 40, "a b " * 30]

    def brute(size):
        words = [WORD.findall(t) for t in texts]
        first = {}
        for d, w in enumerate(words):
            for i in range(len(w) - size + 1):
                first.setdefault(tuple(w[i : i + size]), d)
        out = []
        for d, w in enumerate(words):
            gone = {i + j for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < d for j in range(size)}
            out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
        return out

    for size, bits in ((13, 16), (4, 16), (5, 3)):
        monkeypatch.setattr(substring_dedup, "LEAST_BITS", max(bits, 3))
        monkeypatch.setattr(substring_dedup, "MOST_BITS", max(bits, 3))
        got = substring_dedup.remove_repeated(_docs(spark, texts).repartition(4), size)
        assert rows(got, "doc_id", "n_words", "n_removed", "kept_text") == brute(size)
    spans = {r.doc_id: sum(s.end - s.start for s in r.removed) for r in got.collect()}
    assert spans == {d: n for d, _, n, _ in brute(5)}


# --- quality


def test_counts_by_hand():
    rng = random.Random(2)
    texts = ["", " \n ", "a b\na b\n\n \nA! b#", "é ünï €\n" * 3] + [" ".join(rng.choices(["x", "y", "Zz", "#*", "ñ"], k=k)).replace("Zz y", "\n") for k in (5, 30, 200)]
    got = quality_rules.text_counts(pa.array(texts))
    for i, t in enumerate(texts):
        words = WORD.findall(t)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        repeated = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))
        assert tuple(int(got[c][i]) for c in quality_rules.COUNTS) == want


def test_rules_reject_junk_and_keep_the_rest(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_rules.judge(docs, labels).join(labels, "doc_id").filter("not base_failed")
    share = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.99 and share[0] <= 0.05


def test_path_lengths_by_hand():
    """Scores against a walk down each tree, one row at a time, that counts its splits."""
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(size=(400, 3)), rng.normal(8, 0.1, size=(4, 3))])
    forest = quality_rules.Forest(data, trees=20, sample=64)
    usual = lambda n: 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
    away = data - np.median(data, axis=0)
    stretched = np.sign(away) * away**2
    order = np.random.default_rng(5)
    depths = np.zeros((20, len(data)))
    for t in range(20):
        drawn = stretched[order.permutation(len(data))[:64]]
        stack = [(forest.roots[t], drawn, np.arange(len(data)), 0)]
        # Left branches are grown, and draw their splits, before right ones.
        while stack:
            node, held, rows_in, depth = stack.pop()
            varied = [f for f in range(3) if held[:, f].min() < held[:, f].max()]
            if depth < 6 and len(held) > 1 and varied:
                f = int(order.choice(varied))
                value = order.uniform(held[:, f].min(), held[:, f].max())
                assert (forest.feature[node], forest.value[node]) == (f, value)
                left, right = forest.child[node]
                up, above = held[:, f] > value, stretched[rows_in, f] > value
                stack += [(right, held[up], rows_in[above], depth + 1), (left, held[~up], rows_in[~above], depth + 1)]
            else:
                depths[t, rows_in] = depth + usual(len(held))
    assert np.allclose(forest.score(data), 2 ** (-depths.mean(0) / usual(64)))
    assert forest.score(data)[400:].min() > np.quantile(forest.score(data)[:400], 0.95)


def test_the_verdict_is_not_a_set_of_limits(spark):
    """No box around each rate tells the same: texts within the range of the kept ones go, for how rates go together."""
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality_rules.judge(docs, labels).filter("not base_failed").toPandas()
    columns = [*quality_rules.COUNTS, *quality_rules.MORE]
    rates, kept = quality_rules.features({c: judged[c].to_numpy() for c in columns}), judged.kept.to_numpy()
    assert judged.anomaly.nunique() > 0.9 * len(judged.drop_duplicates("text_key"))
    # Without any one of the rates the forest still sets most of the rejected texts apart.
    for f in range(rates.shape[1]):
        rest = np.delete(rates, f, axis=1)
        score = quality_rules.Forest(rest).score(rest)
        assert (score[~kept][:, None] > score[kept][None, :]).mean() > 0.9, quality_rules.RATES[f]
    # A single limit on one rate, wherever it is put, errs on some texts.
    for f in range(rates.shape[1]):
        for x in (rates[:, f], -rates[:, f]):
            order = np.argsort(x)
            wrong = np.cumsum(~kept[order]) + kept.sum() - np.cumsum(kept[order])
            assert wrong.min() > 0


def test_network_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    network = byte_cnn.train(docs, labels)
    again = byte_cnn.train(docs, labels.withColumn("quality", F.when(byte_cnn.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))))
    assert np.array_equal(network.filters, again.filters) and np.array_equal(network.out, again.out)
    held = byte_cnn.score(docs, network).join(labels, "doc_id").filter(byte_cnn.held_out(F.col("doc_id"))).toPandas()
    good, bad = held.score[held.quality == 1].to_numpy(), held.score[held.quality == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95 and (good >= 0.7).mean() > 0.95


def test_network_from_any_start(spark):
    docs, labels = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "labels"))
    marked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), byte_cnn.held_out(F.col("doc_id")).alias("held")).join(labels, "doc_id").orderBy("doc_id").toPandas()
    fitted, held = marked[~marked.held & (marked.text.str.len() < byte_cnn.FIT_BYTES // 4)], marked[marked.held]
    rows, text = byte_cnn.chunks_of(pa.array(held.text, pa.string()))
    for seed in range(1, 6):
        network = byte_cnn.Network(seed)
        network.fit(pa.array(fitted.text, pa.string()), fitted.quality.to_numpy())
        scores, is_good = network.scores(rows, text, len(held)), held.quality.to_numpy() == 1
        good, bad = scores[is_good], scores[~is_good]
        # Two of the nineteen bad rows may pass.
        assert (good[:, None] > bad[None, :]).mean() > 0.98 and (good >= 0.7).mean() > 0.95 and (bad >= 0.7).sum() <= 2


def test_network_by_hand():
    texts = ["", "ab", "A longer text of words, é.", "xyz " * 150]
    rows, text = byte_cnn.chunks_of(pa.array(texts))
    network, rng = byte_cnn.Network(5), np.random.default_rng(6)
    network.bias, network.out = rng.normal(0, 0.3, byte_cnn.FILTERS), rng.normal(0, 1, byte_cnn.FILTERS + 1)
    network.embed, network.filters = network.embed.astype(float), network.filters.astype(float)

    def forward(t):
        data, step = [b + 1 for b in t.encode()], byte_cnn.CHUNK - byte_cnn.OVERLAP
        pooled = []
        for low in range(0, max(1, len(data) - byte_cnn.OVERLAP), step):
            chunk = (data[low : low + byte_cnn.CHUNK] + [0] * byte_cnn.CHUNK)[: byte_cnn.CHUNK]
            windows = [np.concatenate([network.embed[b] for b in chunk[i : i + byte_cnn.WIDTH]]) for i in range(0, byte_cnn.CHUNK - byte_cnn.WIDTH + 1, byte_cnn.STRIDE)]
            pooled.append([max(0.0, max(float(w @ network.filters[:, f]) for w in windows) + network.bias[f]) for f in range(byte_cnn.FILTERS)])
        return 1 / (1 + np.exp(-(np.mean(pooled, axis=0) @ network.out[:-1] + network.out[-1])))

    assert np.allclose(network.scores(rows, text, len(texts)), [forward(t) for t in texts])

    labels, weight, sizes = np.array([0, 1, 1, 0]), np.array([1.0, 0.5, 2.0, 1.5]), np.bincount(text)
    loss = lambda: float(np.mean(-weight * np.log(np.where(labels == 1, network.scores(rows, text, 4), 1 - network.scores(rows, text, 4)))))
    got = network.gradients(rows, np.arange(4), np.cumsum(sizes) - sizes, sizes, labels, weight)
    for name, d in got.items():
        values = getattr(network, name)
        for at in sorted(np.ndindex(values.shape), key=lambda i: -abs(d[i]))[:6]:
            was, out = values[at], []
            for move in (1e-5, -1e-5):
                values[at] = was + move
                out.append(loss())
            values[at] = was
            assert abs((out[0] - out[1]) / 2e-5 - d[at]) < 1e-4 + 1e-3 * abs(d[at])


def test_chunks_cover_every_byte():
    texts = ["", "a", "b" * 256, "c" * 257, "é" * 1000]
    chunks, text = byte_cnn.chunks_of(pa.array(texts))
    for i, t in enumerate(texts):
        data = t.encode()
        held = chunks[text == i]
        assert len(held) == len(byte_cnn.chunk_starts(np.array([len(data)]))[0])
        step = byte_cnn.CHUNK - byte_cnn.OVERLAP
        back = {}
        for k, row in enumerate(held):
            back |= {k * step + j: v - 1 for j, v in enumerate(row.tolist()) if v}
        assert bytes(back[j] for j in range(len(data))) == data and len(back) == len(data)


# --- near-duplicates


def _edited(rng, words, share):
    return [rng.choice(["new", "other", w + "x"]) if rng.random() < share else w for w in words]


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 30, 200]))]
        texts += [" ".join(_edited(rng, base, s)) for s in (0, 0.002, 0.01, 0.03, 0.2)]
    texts += texts[:4]
    _, n, kmers = order_minhash.labelled_kmers(pa.array(texts))
    ends = np.cumsum(n)
    parts = [kmers[a:b] for a, b in zip(ends - n, ends)]

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        return row[-1]

    links = []
    for i in range(len(texts)):
        for j in range(i):
            same = common(parts[i].tolist(), parts[j].tolist()) if {*parts[i].tolist()} & {*parts[j].tolist()} else 0
            near = same >= 0.8 * (len(parts[i]) + len(parts[j]) - same)
            assert order_minhash.aligned(parts[i], parts[j], 0.8) == near or not same
            if near:
                links.append((j, i))
    want = _components(range(len(texts)), links)
    for block in (500, 2):
        monkeypatch.setattr(order_minhash, "BLOCK_TEXTS", block)
        assert dict(rows(order_minhash.classes(_docs(spark, texts)), "doc_id", "class_id")) == want


def test_short_texts_equal_brute_force(spark):
    rng = random.Random(5)
    texts = []
    for size in range(5, 31):
        for _ in range(20):
            base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
            # One to four words more, at either end: all but the last have 0.8 for some sizes.
            more = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 4))]
            texts += [" ".join(base), " ".join(base + more if rng.random() < 0.5 else more + base)]
    classes = dict(rows(order_minhash.classes(_docs(spark, texts)), "doc_id", "class_id"))
    found = wanted = 0
    for i in range(0, len(texts), 2):
        a, b = (len(t.split()) - 4 for t in texts[i : i + 2])
        near = a >= 0.8 * b
        assert near or classes[i + 1] != i
        found, wanted = found + (near and classes[i + 1] == i), wanted + near
    assert wanted > 150 and found >= 0.99 * wanted


def test_alignment_within_the_band():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = rng.permutation(60)[: rng.integers(1, 60)]
        b = np.delete(a, rng.integers(0, len(a), rng.integers(0, 6)))
        b = np.insert(b, rng.integers(0, len(b) + 1), rng.integers(60, 99, rng.integers(0, 5)))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        assert order_minhash.aligned(a, b, 0.8) == (row[-1] >= 0.8 * (len(a) + len(b) - row[-1]))
    long = rng.permutation(2_000_000)
    assert order_minhash.aligned(long, np.roll(long, 3), 0.8) and not order_minhash.aligned(long, long[::-1], 0.8)


def test_crowds_are_split(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr("passagecraft.functions.sizing.HOT_KEY_ROWS", 20)
    links = spark.range(1, 500).selectExpr("0L as a", "id as b")
    assert {r.root for r in components.components(links).collect()} == {0}
    got = order_minhash.classes(_docs(spark, ["same words " * 9] * 300 + [""] * 200))
    assert sorted(r.class_id for r in got.collect()) == [0] * 300 + [300] * 200


def test_pairs_of_the_table_are_found(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    classes = dict(rows(order_minhash.classes(docs), "doc_id", "class_id"))
    shingles, where = {}, {}
    for r in docs.collect():
        words = WORD.findall(r.text)
        shingles[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
        for s in shingles[r.doc_id]:
            where.setdefault(s, []).append(r.doc_id)
    pairs = {(a, b) for held in where.values() if len(held) < 300 for a in held for b in held if a < b}
    near = [(a, b) for a, b in pairs if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])]
    assert near and sum(classes[a] == classes[b] for a, b in near) >= 0.99 * len(near)


# --- licences and benchmark


def test_licence_spellings(spark):
    shouted = "Copyright (c) 2020 Jane Doe\nAll rights reserved.\n" + MIT.upper().replace("SUBLICENSE", "SUBLICENCE").replace(",", "")
    wrapped = "The  MIT License (MIT)\n\nCopyright © 2021 X\n\n" + MIT.replace(". ", ".\n")
    texts = [shouted, wrapped, BSD_HEAD + BSD_DISCLAIMER, MIT + " more", "Released under the MIT Licence", "text\nlicensed under CC BY-NC 4.0!\nmore", "nothing"]
    got = rows(licence_scan.scan(_docs(spark, texts), licence_scan.known_digests(spark)), "doc_id", "text_licence", "licences")
    assert got == [(0, "MIT", ["MIT"]), (1, "MIT", ["MIT"]), (2, "BSD-2-Clause", ["BSD-2-Clause"]), (3, None, []), (4, "MIT", ["MIT"]),
                   (5, None, ["CC-BY-NC-4.0"]), (6, None, [])]


def test_benchmark_items_in_documents(spark):
    docs, items = (spark.read.parquet(f"{MIDDLE}/{t}.parquet") for t in ("documents", "benchmark"))
    texts, asked = ({r[0]: r[1] for r in t.select(k, "text").collect()} for t, k in ((docs, "doc_id"), (items, "item_id")))
    got = {(r.doc_id, r.item_id) for r in latent_search.search(docs, items).filter("leaked").collect()}
    low = lambda t: " ".join(w for w in re.sub(r"[^\w\s]", " ", t.lower()).split())
    verbatim = {(d, i) for d, t in texts.items() for i, q in asked.items() if low(q) in low(t)}
    assert verbatim and verbatim <= got and len(got - verbatim) <= 0.1 * len(verbatim)


def test_paraphrases_need_the_answer(spark):
    rng = random.Random(6)
    vocabulary = [f"term{i}" for i in range(3000)]
    items = [" ".join(rng.choices(vocabulary, k=24)) + ". " + " ".join(rng.choices(vocabulary, k=6)) + "." for _ in range(12)]

    def changed(text, share, keep_answer):
        words = text.split()
        out = [w if rng.random() > share or (keep_answer and i >= 24) else "changed" + str(rng.randint(0, 999)) for i, w in enumerate(words)]
        return out if keep_answer else out[:24] + ["gone"] * 6

    def around(words):
        return " ".join([*rng.choices(vocabulary, k=150), *words, *rng.choices(vocabulary, k=150)])

    texts = [around(changed(t, 0.3, True)) for t in items] + [around(changed(t, 0.3, False)) for t in items] + [around([]) for _ in range(20)]
    got = rows(latent_search.search(_docs(spark, texts), _docs(spark, items).withColumnRenamed("doc_id", "item_id"), per_round=5).filter("leaked"), "doc_id", "item_id")
    assert got == [(i, i) for i in range(12)]



@pytest.mark.parametrize("size", [65, 400, 1000])
def test_long_items_are_found(spark, size):
    """A passage out of a copy of a long item has little of the item, so the item is cut as well."""
    rng = random.Random(size)
    vocabulary = [f"term{i}" for i in range(200_000)]
    words = lambda n: rng.choices(vocabulary, k=n)
    items = [" ".join(words(size)) for _ in range(6)] + [" ".join(words(20))]
    texts = [" ".join([*words(rng.randint(0, 200)), t, *words(rng.randint(0, 200))]) for t in items]
    # Half an item is none. Terms of a copy are in few of so many documents.
    texts += [" ".join([*words(100), *t.split()[: size // 2], *words(100)]) for t in items[:6]] + [" ".join(words(60)) for _ in range(80)]
    got = rows(latent_search.search(_docs(spark, texts), _docs(spark, items).withColumnRenamed("doc_id", "item_id")).filter("leaked"), "doc_id", "item_id")
    assert got == [(i, i) for i in range(7)]


def test_long_licences_and_variants_of_notices(spark):
    from passagecraft.llm.known_licences import END, LONG

    whole = {name: (known_licences_folder() / f"{file}.txt").read_text() for file, name in LONG.items()}
    apache = whole["Apache-2.0"]
    cases = [(" ".join(text.split("\n")).replace("  ", " ") if name == "MPL-2.0" else text, name) for name, text in whole.items()]
    cases += [(apache.replace("[yyyy] [name of copyright owner]", "2021 Jane Doe"), "Apache-2.0"), (apache[: apache.index(END)] + END, "Apache-2.0"),
              (whole["GPL-2.0"][: whole["GPL-2.0"].index(END)], "GPL-2.0"), (apache + " more", None)]
    cases += [("This program is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"),
              ("Released under the Mozilla Public License 2.0", "MPL-2.0"), ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"),
              ("Licensed under GPLv3 or later.", "GPL-3.0"), ("Licensed under the terms we agreed on", None)]
    got = dict(rows(licence_scan.scan(_docs(spark, [t for t, _ in cases]), licence_scan.known_digests(spark)), "doc_id", "text_licence"))
    assert got == {i: name for i, (_, name) in enumerate(cases)}
    by_digest = licence_scan.known_digests(spark).groupBy("digest").agg(F.count_distinct("licence").alias("n"))
    assert by_digest.filter("n > 1").isEmpty()


def known_licences_folder():
    from pathlib import Path

    return Path(licence_scan.__file__).parent / "licences"
