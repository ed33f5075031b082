"""Each operator against a brute-force version, and on edge cases."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from cladeframe.llm import decontamination, labelled, mixing, neighbours, pseudo_likelihood, quality, shared, simhash, suffix_dedup, token_counts, token_files, toxicity
from cladeframe.llm.queries import vocabulary_file
from cladeframe.llm.shared import coded_words, components, stash, words_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, size long, file string, y int"
ODD_TEXTS = [None, "", "   ", "a", "one two", "the same words twice over " * 3, "x" * 120, "é ß\t\nñ\x0b#2 <|endoftext|> 𝔘", "▁a  b▁ \n c "]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 2 else "s", None, 1, 2, "f", 3) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], (None, "the same words twice over " * 3, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    rows += [(100, "long " * 60_000 + "tail", "en", "s", 5, 1, 2, "f", 3)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def rows(df):
    return [tuple(r) for r in df.collect()]


# components


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, size=(200, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = dict(rows(components(spark.createDataFrame(pairs, "a long, b long"))))
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_components_of_stars_take_no_rounds(spark, monkeypatch):
    """The links of roots that are known already, and links to them that are new."""
    stars = spark.createDataFrame([(1 + k % 3, 10 + k) for k in range(90)], "a long, b long")
    written, kind = [], type(stars)
    monkeypatch.setattr(kind, "checkpoint", lambda self, *a, f=kind.checkpoint: written.append(1) or f(self, *a))
    roots = components(stars)
    assert len(written) == 1 and dict(rows(roots)) == {1: 1, 2: 2, 3: 3} | {10 + k: 1 + k % 3 for k in range(90)}
    more = simhash.as_links(roots).union(spark.createDataFrame([(12, 10), (7, 8)], "a long, b long"))
    assert dict(rows(components(more))) == {1: 1, 2: 2, 3: 1, 7: 7, 8: 7} | {10 + k: 1 if k % 3 != 1 else 2 for k in range(90)}


# SimHash


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_groups(pairs):
    label = [d for d, _ in pairs]
    link = [[j for j, (_, g) in enumerate(pairs) if bin(f ^ g).count("1") <= 2] for _, f in pairs]
    least = lambda x: min([v for v in x if v is not None], default=None)
    while True:
        new = [least([label[j] for j in js]) for js in link]
        if new == label:
            return label
        label = new


def test_simhash_groups(docs, odd):
    for table in (docs, odd):
        texts = rows(table.select("doc_id", "text"))
        want = [(d, plain_fingerprint(t)) for d, t in texts]
        want = sorted([(d, f - (f >> 63 << 64), c) for (d, f), c in zip(want, plain_groups(want))], key=str)
        assert sorted(rows(simhash.simhash_groups(table)), key=str) == want


def test_near_pairs_are_complete(spark):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 63, size=30)]
    fps = {b ^ sum(1 << int(k) for k in rng.choice(63, size=n, replace=False)) for b in base for n in (0, 1, 1, 2, 2, 3, 4)} | {0, -1, 1, 3, -2}
    fps = sorted(fps)
    want = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2}
    assert set(rows(simhash.near_pairs(spark.createDataFrame([(f,) for f in fps], "fp long")))) == want


def test_near_pairs_are_not_broadcast(spark):
    fps = stash(spark.range(1000).select(F.xxhash64("id").alias("fp")), "fps")
    plan = simhash.near_pairs(fps)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_simhash_keeps_the_first_of_each_group(odd, empty):
    for groups in (simhash.simhash_groups(odd), None):
        kept = simhash.keep_first(odd, groups)
        assert kept.columns == odd.columns
        groups = {r.doc_id: r.component_id for r in (groups or simhash.similar_groups(odd)).collect()}
        assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({c for d, c in groups.items() if d is not None})
        assert kept.where("doc_id is null").count() == 2
    assert simhash.keep_first(empty).count() == 0


def test_texts_that_share_an_id_are_kept(spark):
    a, b, c = (f"{w} and some more words about {w} that make it a text of its own" for w in ("one", "two", "three"))
    table = [(5, a, "x"), (5, b, "x"), (7, a, "y"), (9, b, "y"), (9, c, "y"), (9, c, "x"), (11, None, "z"), (11, "", "z"), (None, a, "n"), (12, c, "w")]
    df = spark.createDataFrame(table, "doc_id long, text string, source string")
    got = [tuple(r) for r in simhash.keep_first(df).collect()]
    assert sorted(t for _, t, _ in got if t) == sorted([a, a, b, c])  # a null id stays besides
    assert {t: (d, s) for d, t, s in got if d is not None and t} == {a: (7, "y"), b: (5, "x"), c: (12, "w")}
    assert len([t for _, t, _ in got if not t]) == 1
    assert sorted(simhash.keep_first(df).collect(), key=str) == sorted(map(tuple, got), key=str)


def test_repeated_and_unnamed_items(spark, small):
    import duckdb

    from cladeframe.llm.queries import DECONTAMINATION_SQL

    items = spark.createDataFrame([(7, "alpha beta gamma delta epsilon zeta eta"), (7, "one two three four five six"), (None, "alpha beta gamma delta epsilon zeta eta"), (8, "")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so alpha beta gamma delta epsilon zeta eta end"), (1, "so alpha beta gamma delta epsilon zeta eta end"), (None, "one two three four five six"), (3, None)], "doc_id long, text string")
    con = duckdb.connect()
    con.register("benchmark", items.toArrow())
    con.register("documents", docs.toArrow())
    want = sorted(con.execute(DECONTAMINATION_SQL).fetchall(), key=str)
    got = sorted(rows(decontamination.contaminated(docs, items).select("doc_id", "item_id", "n_shingles", "n_shared", "containment")), key=str)
    assert got == want and len(got) == 5


def plain_similar(pairs):
    """{doc_id: smallest doc_id that similar texts reach}, by all pairs of texts."""
    sets = {}
    for d, t in pairs:
        w = tuple((t or "").lower().split())
        n = min(5, len(w))
        sets.setdefault(frozenset(w[i : i + n] for i in range(len(w) - n + 1)) if w else frozenset(), []).append(d)
    root = {d: d for d, _ in pairs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def link(x, y):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)

    alike = [(s, ids) for s, ids in ((s, [d for d in ids if d is not None]) for s, ids in sets.items()) if ids]
    for k, (s, ids) in enumerate(alike):
        for d in ids:
            link(ids[0], d)
        for other, theirs in alike[:k]:
            if 0.8 * max(len(s), len(other)) <= min(len(s), len(other)):
                shared = len(s & other)
                if shared and shared >= 0.8 * (len(s) + len(other) - shared) - 1e-9:
                    link(ids[0], theirs[0])
    return {d: find(d) for d in root}


def test_similar_groups(spark, docs, odd):
    rng = np.random.default_rng(8)
    made = []
    for k, n in enumerate([9, 25, 60, 150, 400] * 8):
        words = [f"w{x}" for x in rng.integers(0, 500, size=n)]
        for copy in range(12):
            changed = list(words)
            for at in rng.choice(n, size=int(copy * n * 0.004), replace=False):
                changed[at] = f"x{rng.integers(0, 99)}"
            made.append((len(made) * 7 % 480, " ".join(changed[: n - copy % 3])))
    for table in (docs, odd, spark.createDataFrame(made, "doc_id long, text string")):
        assert dict(rows(simhash.similar_groups(table))) == plain_similar(rows(table.select("doc_id", "text")))


def test_similar_links_go_by_the_index_of_fingerprints(spark):
    """Without any other key, texts within two bits are linked, and those alone whose shingles are similar."""
    rng = np.random.default_rng(11)
    made = []
    for k in range(30):
        words = [f"w{x}" for x in rng.integers(0, 500, size=300)]
        made += [(3 * k, " ".join(words)), (3 * k + 1, " ".join([*words, "x"])), (3 * k + 2, " ".join([f"v{x}" for x in words]))]
    table = spark.createDataFrame(made, "doc_id long, text string")
    texts = simhash.sketches(table).select(F.col("doc_id").alias("node"), "fp", "n", F.slice("keys", 1, 0).alias("keys"))
    fps = dict(rows(texts.select("node", "fp")))
    near = {(a, a + 1) for a in range(0, 90, 3) if bin((fps[a] ^ fps[a + 1]) & (2**64 - 1)).count("1") <= 2}
    assert len(near) > 20 and set(rows(simhash.close_texts(texts))) == near
    roots = dict(rows(components(simhash.similar_links(table, texts))))
    assert roots == {x: a for a, b in near for x in (a, b)}
    false = texts.withColumn("fp", F.lit(5).cast("long"))  # of one fingerprint, but not alike
    assert set(rows(components(simhash.similar_links(table, false)))) == {(0, 0), (1, 0)}


def test_similar_groups_of_a_crowd(spark):
    """Hundreds of near copies of one text, each with a change of its own, and a passage that all others share."""
    rng = np.random.default_rng(9)
    base, passage = ([f"w{x}" for x in rng.integers(0, 500, size=120)] for _ in range(2))
    made = []
    for k in range(300):
        changed = list(base)
        for at in rng.choice(120, size=2, replace=False):
            changed[at] = f"x{k}"
        made += [(2 * k, " ".join(changed)), (2 * k + 1, " ".join([f"y{x}" for x in rng.integers(0, 500, size=90)] + passage))]
    table = spark.createDataFrame(made, "doc_id long, text string").repartition(8)
    assert dict(rows(simhash.similar_groups(table))) == plain_similar(made)


def test_short_similar_texts_are_all_found(spark):
    rng = np.random.default_rng(10)
    made = []
    for _ in range(150):
        words = [f"w{x}" for x in rng.integers(0, 9, size=int(rng.integers(4, 46)))]
        for _ in range(4):
            changed = list(words)
            changed[int(rng.integers(len(words)))] = f"x{rng.integers(0, 3)}"
            made.append((len(made), " ".join(changed[int(rng.integers(2)) : len(words) - int(rng.integers(2))])))
    table = spark.createDataFrame(made, "doc_id long, text string")
    assert dict(rows(simhash.similar_groups(table))) == plain_similar(made)


# mixing


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        level = budget / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        out |= {s: 2.0 * sizes[s] for s in over}
        budget -= sum(2 * sizes[s] for s in over)
        free -= over
    return out


def taken_by_queue(table, targets):
    """(doc_id, size, words taken by reading) by the queue itself: sources' documents, twice, by finish time, until the budget is spent."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    docs = [(s, int(hashlib.md5(f"mix|{'' if d is None else d}".encode()).hexdigest()[:13], 16), d, size(t)) for d, s, t in rows(table.select("doc_id", "source", "text"))]
    docs.sort(key=lambda x: (x[0] is None, x[0] or "", x[1], x[2] is not None, x[2] or 0, x[3]))
    ends, queue, total = {}, [], {}
    for s, _, _, n in docs:
        total[s] = total.get(s, 0) + n
    for k, (s, _, _, n) in enumerate(docs):
        ends[s] = ends.get(s, 0) + n
        queue += [((ends[s] + turn * total[s]) / targets[s], s is None, s or "", ends[s] + turn * total[s], k, turn) for turn in (0, 1) if targets[s]]
    left, taken = int(1.5 * sum(total.values())), [[0, 0] for _ in docs]
    for *_, k, turn in sorted(queue):
        taken[k][turn] = min(docs[k][3], left)
        left -= taken[k][turn]
    return [(d, n, taken[k]) for k, (_, _, d, n) in enumerate(docs)]


def test_mixing(docs, odd, empty):
    for table in (docs, odd):
        size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        texts = rows(table.select("source", "text"))
        sizes = {}
        for s, t in texts:
            sizes[s] = sizes.get(s, 0) + size(t)
        want = plain_targets(sizes)
        got = mixing.mix_sizes(table).collect()
        assert len(got) == len(texts)
        taken = {}
        for r in got:
            assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source] and 0 <= r.taken <= 2 * r.size
            taken[r.source] = taken.get(r.source, 0) + r.taken
        longest = max(map(size, (t for _, t in texts)))
        assert sum(taken.values()) == int(1.5 * sum(sizes.values())) and all(abs(n - want[s]) <= longest for s, n in taken.items())
        assert sorted([(d, n, sum(x)) for d, n, x in taken_by_queue(table, want)], key=str) == sorted([(r.doc_id, r.size, r.taken) for r in got], key=str)
        assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sizes(table.repartition(3)).collect()))
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mixing_of_whole_documents(docs):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    longest = docs.select(F.max(mixing.words_in("text"))).first()[0]
    got = dict(rows(mixed.groupBy("source").agg(F.sum(mixing.words_in("text")))))
    for s, t in rows(mixing.mix_sizes(docs).select("source", "target").distinct()):
        assert abs(got[s] - t) <= longest
    assert mixed.groupBy("doc_id").count().where("count > 2").count() == 0


# toxicity and quality


def test_fold_is_crc32_of_the_text(spark):
    for d, f in rows(spark.range(50).select("id", labelled.fold("id"))):
        assert f == zlib.crc32(str(d).encode()) % 5


def held_out(spark, sf):
    d, lab = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    return d, lab, lab.where(labelled.fold() == 0)


def test_toxicity_on_held_out_texts(spark, small):
    d, lab, held = held_out(spark, small.replace("0.001", "0.1"))
    model = toxicity.train(d, lab)
    assert len(model.thresholds) == toxicity.GRADES and (np.diff(model.thresholds) > 0).all()
    got = rows(toxicity.severities(d, model).join(held.select("doc_id", F.col("toxic").alias("y")), "doc_id").select("toxic", "y", "severity", "grade"))
    wrong = sum(bool(y) != t for t, y, _, _ in got)
    assert wrong <= 0.02 * len(got)
    assert all(0 <= s <= toxicity.GRADES for _, _, s, _ in got)
    assert np.mean([s for _, y, s, _ in got if y]) > 10 * np.mean([s for _, y, s, _ in got if not y])


def toxicity_model(spark, graded, **how):
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(graded)], "doc_id long, text string")
    return toxicity.train(d, spark.createDataFrame([(i, y) for i, (_, y) in enumerate(graded)], "doc_id long, toxic int"), **how)


def test_toxicity_with_given_grades(spark):
    texts = ["good day to all"] * 60 + ["bad day to all"] * 60 + ["bad worse day to all"] * 60
    model = toxicity_model(spark, list(zip(texts, [0] * 60 + [1] * 60 + [2] * 60, strict=True)))
    score = toxicity.Scorer(model)
    p = model.grades(np.array([score(t) for t in ("good day to all", "bad day to all", "bad worse day to all")]))
    assert ((p >= 0.5).sum(axis=1) == [0, 1, 2]).all() and (p[:, 0] >= p[:, 1]).all()


def test_toxicity_edge_cases(odd, empty, spark):
    model = toxicity_model(spark, [("quite ok then", 0)] * 60 + [("vile ok then", 1)] * 60)
    assert toxicity.severities(odd, model).count() == odd.count()
    assert toxicity.severities(empty, model).count() == 0
    kept = toxicity.accepted(odd.unionByName(odd.limit(1).withColumn("text", F.lit("vile vile vile"))), model)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for labelled_ in (one, one.where("false")):
        for table in (odd, empty):
            model = toxicity.train(table, labelled_)
            got = toxicity.severities(table, model).collect()
            assert len(got) == table.count() == toxicity.accepted(table, model).count() and len({r.severity for r in got}) == min(1, len(got))


def test_toxicity_of_a_text_from_weights():
    """The severity by hand, from what the model holds."""
    model = toxicity.Model({"vil": 0.5, "vile": 0.25, "=vile": 1.0, "=day": -0.5, "da": 9.0}, np.array([0.5, 1.0, 3.0]))
    words = "vile day vilest vile".split()
    by_word = {"vile": 1.75, "day": -0.5, "vilest": 0.75}
    score = 100 * sum(by_word[w] for w in words) / (len(words) + 10)
    assert toxicity.Scorer(model)(" ".join(words)) == pytest.approx(score)
    p = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
    assert model.grades(np.array([score]))[0] == pytest.approx(p)


def test_quality_on_held_out_texts(spark, small):
    d, lab, held = held_out(spark, small.replace("0.001", "0.1"))
    got = rows(quality.quality_scores(d, quality.train(d, lab)).join(held, "doc_id").select("score", "predicted", "quality", "held_out"))
    assert all(h for *_, h in got) and all((p == 1) == (s >= 0.3) for s, p, _, _ in got)
    assert sum(p != q for _, p, q, _ in got) <= 0.02 * len(got)


def test_dictionary_sees_the_last_pieces():
    rng = np.random.default_rng(2)
    piece = lambda words: " ".join(words[k] for k in rng.integers(0, len(words), 80)).encode()[: quality.PIECE]
    early, late = ([f"{x}{k}word" for k in range(300)] for x in ("early", "late"))
    assert b"late" in quality.dictionary([piece(early) for _ in range(9000)] + [piece(late) for _ in range(4000)])


def test_quality_edge_cases(odd, empty, spark):
    texts = [f"plain words go here and there {i}" for i in range(40)] + [f"@@@ ### !!! $$$ {i}" for i in range(40)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = quality.train(d, d.select("doc_id", (F.col("doc_id") < 40).cast("int").alias("quality")))
    got = quality.quality_scores(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.quality_scores(empty, model).count() == 0
    for labelled_, share in ((d.select("doc_id", F.lit(1).alias("quality")), None), (d.where("false").select("doc_id", F.lit(1).alias("quality")), 0.5)):
        for table in (odd, empty, d):
            got = quality.quality_scores(table, quality.train(table, labelled_)).collect()
            assert len(got) == table.count() and len({r.score for r in got}) == min(1, len(got)) and (share is None or all(r.score == share for r in got))


def test_quality_of_a_text_by_hand(docs):
    """The score from the sizes of a text's pieces under either dictionary."""
    import zstandard

    good, bad = (quality.dictionary([f"{w} {k} {w}s and {w}ing".encode() * 5 for k in range(300)]) for w in ("plain", "gross"))
    model = quality.Model(good, bad, 0.02, 0.01, -4.0, 1.5, -0.2)
    measure = model.measure()
    for (t,) in rows(docs.select("text").limit(20)):
        t = (t or "").encode()
        sizes = [sum(len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False).compress(t[i : i + 512])) for i in range(0, len(t), 512)) for d in (bad, good)]
        x = (sizes[0] - sizes[1]) / len(t) if t else 0.0
        assert measure(t) == pytest.approx(x)
        z = min(1, max(-4, (x - 0.02) / 0.01))
        assert model.score(np.array([x]))[0] == pytest.approx(1 / (1 + np.exp(-(1.5 * z - 0.2))))


# tokens


def write(table, **how):
    return token_files.write_tokens(table, vocabulary_file("byte_bpe_50k.json"), 2, **how)


def test_token_files_round_trip(docs, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_file("byte_bpe_50k.json"))
    for table, how in ((docs, {}), (odd, {"length": 16, "sequences": 4}), (odd.where("doc_id = 3"), {"length": 2, "sequences": 1})):
        texts = sorted(rows(table.select("doc_id", F.coalesce("text", F.lit("")))), key=lambda r: (r[0] is not None, r[0] or 0))
        ids = [tokenizer.encode(t, add_special_tokens=False).ids + [2] for _, t in texts]
        files = write(table, **how)
        got = sorted(rows(token_files.read_tokens(files).select("doc_id", "start", "n_tokens", "ids_crc32")), key=lambda r: r[1])
        starts = np.cumsum([0] + [len(x) for x in ids])
        assert [r[0] for r in got] == [d for d, _ in texts]
        if table is docs:
            assert got == [(d, int(s), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, _), s, x in zip(texts, starts, ids)]
        else:
            assert sum(r[2] for r in got) == starts[-1] and sorted(r[3] for r in got) == sorted(zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids)


def test_token_files_grow_in_number(docs):
    whole = rows(token_files.read_tokens(write(docs)).select("doc_id", "start", "n_tokens", "ids_crc32"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    for task_bytes, file_tokens in ((size // 3, 1 << 24), (1 << 30, 2000), (size // 5, 2000), (size // 4, 1)):
        files = write(docs, length=64, sequences=8, task_bytes=task_bytes, file_tokens=file_tokens)
        listed = files.orderBy("part", "number").collect()
        got = token_files.read_tokens(files)
        assert sorted(rows(got.select("doc_id", "start", "n_tokens", "ids_crc32"))) == sorted(whole)
        longest = got.agg(F.max("n_tokens")).first()[0]
        assert all(f.tokens < 2 * file_tokens + longest for f in listed)
        assert len({f.part for f in listed}) == min(-(-size // task_bytes), len(listed))
        first = [r[0] for r in got.groupBy("file").agg(F.min("doc_id").alias("a")).join(files, "file").orderBy("part", "number").select("a").collect()]
        assert first == sorted(first) and len(first) == len(listed)


def test_sequences_are_read_at_random(docs):
    f = write(docs, length=64, sequences=8).first()
    reader = token_files.open_sequences(f"{f.folder}/{f.file}.arrow")
    flat = np.concatenate([reader.get_batch(b).column(0).flatten().to_numpy() for b in range(reader.num_record_batches)])
    total = -(-f.tokens // 64)
    for r in (0, 7, 8, total // 2, total - 1):
        ids, mask = token_files.row(reader, r, 8)
        assert (ids == flat[r * 64 : r * 64 + 64]).all() and mask.sum() == min(64, f.tokens - 64 * r)
        assert not ids.flags.owndata


def test_token_files_of_nothing(empty):
    assert token_files.read_tokens(write(empty)).count() == 0


@pytest.mark.parametrize("fallback", [True, False])
def test_token_counts(docs, odd, empty, fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_counts.read_vocabulary(vocabulary_file("piece_bpe_32k.model"))
    plain = Tokenizer(models.Unigram(list(pieces), unk_id=0, byte_fallback=fallback))
    plain.pre_tokenizer = pre_tokenizers.Metaspace(replacement=token_counts.MARK, prepend_scheme="always", split=True)
    for table in (docs, odd):
        want = sorted([(d, len(plain.encode(t or "").ids)) for d, t in rows(table.select("doc_id", "text"))], key=str)
        assert sorted(rows(token_counts.token_counts(table, vocabulary_file("piece_bpe_32k.model"), fallback)), key=str) == want
    assert token_counts.token_counts(empty, vocabulary_file("piece_bpe_32k.model")).count() == 0


def test_token_count_ties():
    from tokenizers import Tokenizer, models

    rng = np.random.default_rng(4)
    for _ in range(30):
        names = {"".join(rng.choice(list("abc"), size=int(n))) for n in rng.integers(1, 5, size=12)}
        pieces = [("<unk>", 0.0)] + [(p, -float(rng.integers(1, 4))) for p in sorted(names)]
        plain, mine = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False)), token_counts.Counter(pieces, False)
        for _ in range(20):
            text = "".join(rng.choice(list("abcd"), size=12))
            assert mine.count(text) == len(plain.encode(text).ids)


# decontamination


def test_decontamination(spark, small):
    sf = small.replace("0.001", "0.01")
    d, b = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    cut = b.limit(3).select((F.col("item_id") + 1000).alias("item_id"), F.regexp_extract("text", r"^(\w+ \w+ \w+)", 1).alias("text"))
    b = b.unionByName(cut).unionByName(spark.createDataFrame([(1, None), (2000, " . ")], "item_id long, text string"))

    def shingles(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    want, docs_ = [], [(i, re.findall(r"\w+", t.lower())) for i, t in rows(d.select("doc_id", "text"))]
    for item, text in rows(b.select("item_id", "text")):
        w = re.findall(r"\w+", (text or "").lower())
        s = shingles(w, min(5, len(w))) if w else set()
        for doc, x in docs_:
            k = len(s & shingles(x, min(5, len(w)))) if s else 0
            if s and k >= 0.8 * len(s):
                want.append((doc, item, len(s), k, k / len(s)))
    got = rows(decontamination.contaminated(d, b))
    assert sorted(got) == sorted(want) and len(want) > 20
    assert sorted(rows(decontamination.contaminated(d, b, block_words=60))) == sorted(want)
    assert {r.doc_id for r in decontamination.clean(d, b).collect()} == {i for i, _ in docs_} - {r[0] for r in want}


def test_decontamination_finds_items_with_gaps_in_long_texts(spark):
    words = [f"w{i}" for i in range(60)]
    broken = [*words[:30], "gap", *words[30:]]  # 4 of 56 shingles lost
    worse = [x for i, w in enumerate(words) for x in ((w, "gap") if i % 15 == 0 else (w,))]
    far = [f"z{i}" for i in range(30_000)]
    d = spark.createDataFrame([(1, " ".join(far + broken + far)), (2, " ".join(worse)), (3, None), (None, " ".join(words))], "doc_id long, text string")
    b = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    assert {r[:2] for r in rows(decontamination.contaminated(d, b))} == {(1, 7), (None, 7)}
    assert decontamination.contaminated(d, b.where("false")).count() == 0 and decontamination.clean(d, b.where("false")).count() == 4


def test_words_have_their_marks(spark):
    assert words_of("A\u0301b हिन्दी x_1 ½ – \u0301c") == ["a\u0301b", "हिन्दी", "x_1", "½", "\u0301c"] and words_of(None) == []
    item = "cafe\u0301 one two three four five six हिन्दी seven eight"
    d = spark.createDataFrame([(1, f"so {item} end"), (2, item.replace("\u0301", "").replace("हिन्दी", "हन्द"))], "doc_id long, text string")
    got = rows(decontamination.contaminated(d, spark.createDataFrame([(7, item)], "item_id long, text string")))
    assert got == [(1, 7, 6, 6, 1.0)]


def test_coded_words_are_those_of_words_of(monkeypatch):
    texts = [f"A{chr(c)}B {chr(c)}" for c in range(0x3000)] + [*ODD_TEXTS, "İstanbul ȺB «é» ª²½×÷", "A\u0301b हिन्दी \u0301c", "\0a\0", "\x1c𝔘\x1f"]
    assert list(coded_words([])) == []
    for size in (1, 1000, shared.CODED):
        monkeypatch.setattr(shared, "CODED", size)
        got = []
        for words, places, lengths in coded_words(texts):
            names, ends = words.to_pylist(), np.cumsum(lengths)
            assert len(set(names)) == len(names)
            got += [[names[i] for i in places[end - n : end]] for end, n in zip(ends, lengths)]
        assert got == [words_of(t) for t in texts]


def test_counting_words_costs_less_than_finding_each():
    rng = np.random.default_rng(0)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, 500) % 50_000) for _ in range(400)]

    def seconds(count) -> float:
        start = time.process_time()
        count()
        return time.process_time() - start

    plain = min(seconds(lambda: Counter(w for t in texts for w in words_of(t))) for _ in range(3))
    coded = min(seconds(lambda: [np.bincount(places) for _, places, _ in coded_words(texts)]) for _ in range(3))
    assert coded < 0.7 * plain


# suffix arrays


def plain_removal(texts):
    """texts: (doc_id, bytes). Windows by their bytes with the smallest doc_id."""
    least = {}
    for d, t in texts:
        for i in range(len(t) - 49):
            if d is not None:
                least[t[i : i + 50]] = min(d, least.get(t[i : i + 50], d))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 49):
            if d is not None and least[t[i : i + 50]] < d:
                gone[i : i + 50] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [20_000, 1 << 23])
def test_suffix_dedup(docs, odd, empty, size):
    for table in (docs, odd):
        texts = [(d, (t or "").encode()) for d, t in rows(table.select("doc_id", "text"))]
        got = rows(suffix_dedup.remove_repeats(table, batch_bytes=size))
        assert sorted(got, key=str) == plain_removal(texts)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_of_edited_copies(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "WINDOWS", 500)  # so that the family has levels
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 900)
    rng = np.random.default_rng(3)
    base, texts = bytes(rng.integers(97, 101, size=3000, dtype=np.uint8)), []
    for d in range(40):
        t = bytearray(base[int(rng.integers(0, 1500)) : int(rng.integers(1600, 3000))])
        for k in rng.integers(0, len(t), size=int(rng.integers(0, 12))):
            t[k] = int(rng.integers(97, 101))
        texts.append((int(rng.integers(0, 30)), bytes(t)))
    texts += [(50, b"\0" * 300), (51, b"\0" * 120 + b"a" + b"\0" * 60), (52, b"ab" * 100)]
    table = spark.createDataFrame([(d, t.decode()) for d, t in texts], "doc_id long, text string")
    for size, hot in ((3000, 1 << 20), (1 << 20, 1 << 20), (3000, 30), (3000, 2)):
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        for together, merged in ((8, 4), (1, 1), (3, 2)):
            monkeypatch.setattr(suffix_dedup, "GATHER", together)
            monkeypatch.setattr(suffix_dedup, "MERGED", merged)
            assert sorted(rows(suffix_dedup.remove_repeats(table, batch_bytes=size)), key=str) == plain_removal(texts)
    kept = {r.kept_sha256: r.kept for r in suffix_dedup.remove_repeats(table, with_text=True).collect()}
    assert all(hashlib.sha256(v).hexdigest() == k for k, v in kept.items())


# neighbours


def plain_nearest(vectors, k):
    good = [(i, v) for i, v in vectors if v is not None and len(v) == 8 and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q, a in good:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum())), i) for i, b in good if i != q)[:k]
            out += [(q, r + 1, i, s) for r, (s, i) in enumerate(near)]
    return out


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


HARD_VECTORS = {
    "unit vectors of few components": lambda rng: unit(rng.normal(size=(5000, 4))),
    "tight clusters": lambda rng: np.repeat(rng.normal(size=(20, 64)), 250, axis=0) + rng.normal(size=(5000, 64)) * 0.02,
    "whole numbers": lambda rng: rng.integers(0, 4, size=(5000, 6)),
    "many rows": lambda rng: unit(rng.normal(size=(100_000, 64))),
}


@pytest.mark.parametrize("kind", HARD_VECTORS)
def test_recall_of_hard_vectors(spark, tmp_path, kind):
    import pyarrow as pa
    import pyarrow.parquet as pq

    x = HARD_VECTORS[kind](np.random.default_rng(0)).astype(np.float32)
    offsets = pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32())
    pq.write_table(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))}), tmp_path / "v.parquet")
    table, x, step = spark.read.parquet(str(tmp_path / "v.parquet")), x.astype(np.float64), len(x) // 50
    got = {}
    for r in neighbours.nearest(table, table.where(f"vec_id % {step} = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i in range(0, len(x), step):
        far = ((x - x[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        hits += len(got[i] & set(np.lexsort((np.arange(len(x)), far))[:10].tolist()))
    assert hits >= 0.95 * 10 * len(got)


def test_neighbours_recall(spark, small):
    v = spark.read.parquet(f"{small.replace('0.001', '0.1')}/embeddings.parquet")
    got = rows(neighbours.nearest(v, v.where("vec_id % 100 = 0")))
    ids, x = zip(*rows(v.select("vec_id", "embedding")))
    x, ids = np.array(x, dtype=float), np.array(ids)
    hits = 0
    for q in sorted({r[0] for r in got}):
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        mine = sorted([r for r in got if r[0] == q], key=lambda r: r[1])
        assert [r[1] for r in mine] == list(range(1, 11)) and [r[3] for r in mine] == sorted(r[3] for r in mine)
        assert all(abs(d[ids == r[2]][0] - r[3]) < 1e-12 for r in mine)
        hits += len(set(ids[np.argsort(d)[:10]]) & {r[2] for r in mine})
    assert hits >= 0.98 * len(got)


def test_neighbours_edge_cases(spark):
    rng = np.random.default_rng(5)
    rows_ = [(i, [float(a) for a in rng.normal(size=8)]) for i in range(120)] + [(200 + i, [1.0] * 8) for i in range(300)]
    bad = [(500, None), (600, []), (700, [0.0] * 8), (800, [float("nan")] + [1.0] * 7), (900, [None] + [1.0] * 7), (1000, [1.0] * 5), (None, [1.0] * 8), (1100, [float("inf")] + [1.0] * 7)]
    table = spark.createDataFrame(rows_ + bad + rows_[:2], "vec_id long, embedding array<float>")
    clean = [(i, [float(np.float32(a)) for a in v]) for i, v in rows_]
    got = sorted(rows(neighbours.nearest(table, table.where("vec_id % 100 = 0"), part=100, rerank=200)))
    want = plain_nearest(clean, 10)
    assert [r[:3] for r in got] == [r[:3] for r in sorted(want)]
    assert neighbours.nearest(table.where("vec_id < 0"), table).count() == 0
    few = table.where("vec_id in (0, 1, 2)")
    assert neighbours.nearest(few, few.where("vec_id = 0")).count() == 2


def test_parallel_residuals_are_smaller_with_anisotropic_codes():
    x = np.random.default_rng(6).normal(size=(1500, 16))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)

    def parallel(eta):
        w = neighbours.fit(x, eta=eta)
        c = neighbours.encode(x, w, eta=eta)
        r = x - w[np.arange(8)[None], c].reshape(len(x), -1)
        return ((r * unit).sum(axis=1) ** 2).mean()

    assert parallel(neighbours.ETA) < 0.7 * parallel(1.0)


# pseudo-likelihood


def test_pseudo_likelihood(docs, odd, empty):
    known, net = pseudo_likelihood.train(docs, every=1)
    fresh = pseudo_likelihood.Network.new()
    got = {r.doc_id: r for r in pseudo_likelihood.pseudo_likelihoods(docs, known, net).collect()}
    for d, t in rows(docs.select("doc_id", "text").limit(5)):
        ids = [known.get(w, 1) for w in re.findall(r"\w+", t.lower())]
        total = 0.0
        for i, own in enumerate(ids):
            h = net.bias.astype(float)
            for k, o in enumerate(pseudo_likelihood.OFFSETS):
                h = h + net.tables[k][ids[i + o] if 0 <= i + o < len(ids) else 0]
            z = np.tanh(h) @ net.out + net.out_bias
            total += z[own] - np.log(np.exp(z).sum())
        assert got[d].n_tokens == len(ids) and got[d].log_likelihood == pytest.approx(total, rel=1e-4)
    untrained = pseudo_likelihood.pseudo_likelihoods(docs, known, fresh).agg(F.sum("log_likelihood")).first()[0]
    assert sum(r.log_likelihood for r in got.values()) > 0.6 * untrained
    assert pseudo_likelihood.pseudo_likelihoods(odd, known, net).count() == odd.count()
    assert pseudo_likelihood.pseudo_likelihoods(empty, *pseudo_likelihood.train(empty)).count() == 0


def test_words_in_order_are_likelier_than_shuffled_ones(spark):
    text = "the cat sat on the mat and the dog ran to the park " * 40
    table = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string")
    known, net = pseudo_likelihood.train(table, every=2)
    words = text.split()
    np.random.default_rng(0).shuffle(words)
    pair = spark.createDataFrame([(1, text), (2, " ".join(words))], "doc_id long, text string")
    a, b = (r.mean_log_likelihood for r in pseudo_likelihood.pseudo_likelihoods(pair, known, net).orderBy("doc_id").collect())
    assert a > b + 0.5


def test_words_beyond_the_commonest_are_predicted(spark, docs):
    known, net = pseudo_likelihood.train(docs)
    prose = docs.where("lang = 'en' and n_chars > 2000").orderBy("doc_id").first().text
    junk = ["Bever " * 300, "zqxv wvkk jjxq " * 100, "qqqq xxxxxxxxxx " * 150]
    table = spark.createDataFrame(list(enumerate([prose, *junk])), "doc_id long, text string")
    for tokens in (pseudo_likelihood.TOKENS, 300):
        if tokens == 300:
            known, net = pseudo_likelihood.train(docs, tokens=tokens)
        means = [r.mean_log_likelihood for r in pseudo_likelihood.pseudo_likelihoods(table, known, net).orderBy("doc_id").collect()]
        assert len({round(m, 6) for m in means}) == 4 and means[0] > max(means[1:]) and means[0] > max(means[2:]) + 10, (tokens, means)
    total = np.bincount(net.words.classes, weights=np.exp(net.words.within.astype(float)))
    assert total == pytest.approx(np.ones(len(total)), rel=1e-4) and len(known) <= 298
    assert np.exp(net.words.spelling.astype(float)).reshape(-1, 256).sum(axis=1) == pytest.approx(1.0, rel=1e-4)


def test_training_does_not_depend_on_the_partitioning(docs, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "SHARD", 20_000)
    nets = [pseudo_likelihood.train(docs.repartition(n), tokens=2000)[1] for n in (2, 9)]
    assert np.abs(nets[0].flat() - nets[1].flat()).max() < 1e-5


def test_training_takes_every_position_once():
    packed = np.arange(2, 1003, dtype="<u2").tobytes()
    parts = [pseudo_likelihood.places_of(packed, 1001, pseudo_likelihood.EVERY, pseudo_likelihood.ROUNDS, k) for k in range(pseudo_likelihood.ROUNDS)]
    assert sorted(np.concatenate(parts)) == list(range(1001))


# the pipeline


def test_pipeline_stages(spark, small):
    import corpus_pipeline
    from cladeframe.llm.shared import stash

    sf = small.replace("0.001", "0.01")
    d = spark.read.parquet(f"{sf}/documents.parquet")
    before, columns, by_name = d, d.columns, dict(corpus_pipeline.STAGES)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stash(stage(spark, before, sf), name)
        seen[name] = after
        if name != "token_files":
            assert after.columns == columns
            before = after
    ids = lambda name: {r.doc_id for r in seen[name].collect()}
    model = toxicity.train(d, spark.read.parquet(f"{sf}/labels.parquet"))

    def toxic(text):
        words = re.findall(r"\w+", (text or "").lower())
        score = sum(100 * model.weights.get(f, 0.0) / (len(words) + 10) for w in words for f in [w[:k] for k in range(3, min(len(w), 8) + 1)] + ["=" + w])
        return 1 / (1 + np.exp(model.thresholds[0] - score)) >= 0.5

    assert ids("toxicity") == {i for i, t in rows(d.select("doc_id", "text")) if not toxic(t)}
    groups = plain_similar(rows(seen["toxicity"].select("doc_id", "text")))
    assert ids("near_duplicates") == set(groups.values())
    items = [frozenset(zip(*(w[k:] for k in range(min(5, len(w)))))) for w in (re.findall(r"\w+", (t or "").lower()) for (t,) in rows(spark.read.parquet(f"{sf}/benchmark.parquet").select("text")))]

    def holds(text):
        words = re.findall(r"\w+", (text or "").lower())
        have = {n: set(zip(*(words[k:] for k in range(n)))) for n in {len(next(iter(i))) for i in items if i}}
        return any(i and len(i & have[len(next(iter(i)))]) >= 0.8 * len(i) - 1e-9 for i in items)

    assert ids("decontamination") == {i for i, t in rows(seen["near_duplicates"].select("doc_id", "text")) if not holds(t)}
    clean = seen["decontamination"]
    sizes = dict(rows(clean.groupBy("source").agg(F.sum(mixing.words_in("text")))))
    copies = sorted(x for doc, n, x in taken_by_queue(clean, plain_targets(sizes)) for x in [doc] * sum(2 * y >= n for y in x))
    assert sorted(r.doc_id for r in seen["mixing"].collect()) == copies
    from tokenizers import Tokenizer

    tokenizer, start = Tokenizer.from_file(vocabulary_file("byte_bpe_50k.json")), 0
    got = sorted(rows(seen["token_files"].select("start", "doc_id", "n_tokens", "ids_crc32")))
    texts = dict(rows(clean.select("doc_id", "text")))
    assert [r[1] for r in got] == copies
    for at, doc, n, crc in got:
        encoded = tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [2]
        assert (at, n, crc) == (start, len(encoded), zlib.crc32(np.array(encoded, "<u4").tobytes()))
        start += n
    assert len(by_name) == 5


def test_pipeline_on_empty_tables(spark, small, tmp_path):
    import corpus_pipeline

    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{small}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_clashing_columns(spark, odd):
    from cladeframe.llm.shared import stash

    model = toxicity_model(spark, [("quite ok then", 0)] * 60 + [("vile ok then", 1)] * 60)
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    table = toxicity.accepted(odd, model)
    for stage in (simhash.keep_first, lambda t: decontamination.clean(t, items), mixing.mix):
        table = stash(stage(table), "odd")
        assert table.columns == odd.columns
    assert token_files.read_tokens(write(table)).count() == table.count()
