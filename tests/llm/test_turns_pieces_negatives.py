"""The operators for pieces, conversations and hard negatives against plain versions, and on edge cases."""

import random
import re
import zlib
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeframe.llm import hard_negatives, pieces, queries, turn_repair
from cladeframe.llm.queries import vocabulary_file

MODEL = "piece_bpe_32k.model"


def rows(df):
    return [tuple(r) for r in df.collect()]


# pieces


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(vocabulary_file(MODEL))


ODD = [
    "", " ", "  ", "a", "▁", "▁▁ a", " " * 7 + "x", "x" * 999, "é ß\t\nñ\x0b#2 <|endoftext|> 𝔘 <0x0A> <s></s><unk>", "\x00a\x00", "日本語の文章です。中文", "aaaa " * 50, "  Hello  wor\nld ▁x\t ", "👩‍👩‍👧 ok", "﻿abc", "ﬁ ①",
    "long " * 40_000 + "tail", "y" * 50_000,
]


def of_library(encoder, text):
    ids = encoder.model.encode(text or "", add_bos=True, add_eos=True)
    return np.array(ids, dtype="<u4").tobytes(), encoder.model.decode(ids)


def test_pieces_are_those_of_the_library(encoder):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("abcdehilnorst  ▁éñü.\n12,日") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    for text in texts:
        assert (encoder.encode(text), pieces.decoded(vocabulary_file(MODEL), encoder.encode(text))) == of_library(encoder, text)


def test_memories_may_be_small(encoder, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_CUTS", 2)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 3)
    text = "Some words, and some more words that come again and again. " * 3
    encoder.clear()
    encoder.pairs.clear()
    assert encoder.encode(text) == of_library(encoder, text)[0]
    assert len(encoder) <= 2 and len(encoder.pairs) <= 3


def test_the_query_encodes_whole_texts(spark, small, encoder):
    got = {r[0]: r[1:] for r in rows(queries.encode_pieces(spark, small).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))}
    want = {}
    for doc_id, text in rows(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")):
        ids, decoded = of_library(encoder, text)
        want[doc_id] = (len(ids) // 4, sha256(ids).hexdigest(), sha256(decoded.encode()).hexdigest())
    assert got == want


def test_pieces_of_odd_tables(spark, encoder):
    table = spark.createDataFrame([(1, None, b"x"), (1, "twice", b"y"), (1, "twice", b"y"), (None, "", None)], "doc_id long, text string, ids binary")
    model = vocabulary_file(MODEL)
    got = [(i, bytes(b), d) for i, b, d in rows(pieces.decode(pieces.encode(table, model), model))]
    assert sorted(map(str, got)) == sorted(str((i, *of_library(encoder, t))) for i, t, _ in rows(table))
    assert rows(pieces.encode(table.limit(0), model)) == []
    assert rows(pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), model)) == [(1, None, "")]


# conversations


def spaced(x):
    return " " if x is None else str(x)


def damage(table):
    out = []
    for conv, turn, role, text in table:
        role, text = spaced(role), spaced(text)
        k = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def cheapest(kept):
    """Least (cost, audit, roles and rows) over the grammar's states, row by row. kept: (row, initial, fault)."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def inserted(front):
        front = dict(front)
        for _ in range(4):
            for s, (c, a, out) in list(front.items()):
                role = after[s]
                made = (c + 5, a + "I", [*out, (role, None)])
                if role not in front or made[:2] < front[role][:2]:
                    front[role] = made
        return front

    front = {"": (0, "", [])}
    for row, initial, fault in kept:
        nxt = {}

        def put(state, made, nxt=nxt):
            if state not in nxt or made[:2] < nxt[state][:2]:
                nxt[state] = made

        for s, (c, a, out) in (front if fault in ("blank", "duplicate") else inserted(front)).items():
            put(s, (c + 2, a + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            role = after[s]
            put(role, (c + more, a + "K", [*out, (None, row)]) if initial == role else (c + 1 + more, a + "R", [*out, (role, row)]))
            if s == "" and initial == "s":
                put("s", (c + more, a + "K", [*out, (None, row)]))
        front = nxt
    front = inserted(front)
    return min((front[s] for s in ("", "a") if s in front), key=lambda f: f[:2])


def repaired(table, lines):
    """The contract's rows for a whole table, in plain Python."""
    result = {}
    for conv in {r[0] for r in table}:
        mine = sorted((r for r in lines if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        seen, kept, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for r in mine:
            said = re.findall(r"[^\x20\x09-\x0D]", r[3])
            fault = "blank" if not said else "duplicate" if r[2:] in seen else "truncated" if said[-1] not in ".!?" else None
            seen.add(r[2:])
            if fault:
                counts[fault] += 1
            kept.append((r, r[2][:1], fault))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1] + b[1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:], strict=False))
        cost, audit, out = cheapest(kept)
        names = {"u": "user", "a": "assistant"}
        lines_out = [f"{names[role] if role else row[2]}:{row[3] if row else ''}" for role, row in out]
        result[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha256("\n".join(lines_out).encode()).hexdigest())
    return result


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_damaged_conversations_are_repaired(spark, small, tmp_path):
    for folder in (small, small.replace("sf0.001", "sf0.01")):
        table = rows(spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text"))
        got = {r[0]: r[1:] for r in rows(queries.repair_turns(spark, folder).select("conv_id", *COLUMNS))}
        assert got == repaired(table, damage(table))


def odd_conversations():
    rng = random.Random(5)
    table = [(None, None, None, None), (None, 3, "user", "Yes."), (None, 3, "user", "Yes."), (1, None, "system", "Be kind."), (1, None, "system", "Be brief."), (1, 0, "", "No role."), (1, 2, "users", "Hm."), (1, 9, "Assistant", "A."), (2, -5, "tool", " \t "), (2, -5, "assistant", " "), (3, 1, "s", "x.\n")]
    for conv in range(10, 40):
        table += [(conv, rng.choice([t, t, t, t + 1, None]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]), rng.choice(["Yes.", "No!", "Well", "", "What? ", "I see.", str(t) + "."])) for t in range(rng.randint(1, 40))]
    return table


@pytest.mark.parametrize("block", [3, 512])
def test_odd_conversations_in_blocks(spark, block):
    table = odd_conversations()
    report, fixed = turn_repair.repair(spark.createDataFrame([(*r, "x") for r in table], "conv_id long, turn long, role string, text string, c string"), block)
    lines = [(c, t, spaced(r), spaced(x)) for c, t, r, x in table]
    got = {r[0]: r[1:] for r in rows(turn_repair.with_empty(spark.createDataFrame([(r[0],) for r in table] + [(77,)], "conv_id long"), report, turn_repair.digests(fixed)).select("conv_id", *COLUMNS))}
    assert got.pop(77) == (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert got == repaired(lines, lines)


def test_no_conversations(spark):
    report, fixed = turn_repair.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert rows(report) == [] and rows(fixed) == [] and rows(turn_repair.digests(fixed)) == []


def test_bands_hold_the_best_alignment():
    rng, end = random.Random(3), tuple(5.0 * len(turn_repair.CLOSING[s]) for s in turn_repair.STATES)
    for _ in range(600):
        letters = "".join(rng.choice(rng.choice(["ua", "uaUA", "suaSUA-+", "ss", "uua", "+"])) for _ in range(rng.randint(0, 40)))
        kept = [(None, x.lower(), "truncated" if x in "SUA+" else None) for x in letters]
        cost, audit = turn_repair.aligned(letters, turn_repair.BEGIN, end)
        state, _ = turn_repair.walked(letters, turn_repair.BEGIN, audit)
        assert (cost, audit + turn_repair.CLOSING[state]) == cheapest(kept)[:2]


# hard negatives


@pytest.mark.parametrize("dims, bits", [(2, 3), (3, 2), (5, 1)])
def test_neighbours_on_the_curve_are_neighbours(dims, bits):
    points = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims), -1).reshape(-1, dims)
    keys = hard_negatives.hilbert(points, bits)
    order = sorted(range(len(points)), key=keys.__getitem__)
    assert len(set(keys)) == len(points)
    assert all(abs(points[a] - points[b]).sum() == 1 for a, b in zip(order, order[1:], strict=False))


def test_intervals_hold_all_products():
    rng = np.random.default_rng(2)
    a, x = rng.integers(-300, 300, size=(20, 16)).astype(float), rng.integers(-300, 300, size=(50, 16)).astype(float)
    least, most = hard_negatives.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    score = a @ x.T
    assert (least[:, 0] <= score.min(axis=1)).all() and (most[:, 0] >= score.max(axis=1)).all()


def by_sql(df):
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    return sorted(con.execute(queries.NEGATIVES_SQL).fetchall())


SCHEMA = "vec_id long, embedding array<float>, label int, page int, number string, dim long"


def clustered(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, dims))
    x = middles[rng.integers(12, size=n)] + rng.normal(size=(n, dims)) * 0.3
    return [(i, [float(v) for v in x[i]], int(rng.integers(labels)), 1, "x", 2) for i in range(n)]


def test_blocks_and_chunks_of_any_size(spark):
    table = spark.createDataFrame(clustered(1500, 5, 1), SCHEMA)
    want = by_sql(table)
    assert len(want) > 200
    for block, chunk in ((16, 4), (1024, 256)):
        assert sorted(rows(hard_negatives.mine(table, block=block, chunk=chunk))) == want


def test_zone_maps_leave_blocks_unread(spark):
    table = hard_negatives.quantised(spark.createDataFrame(clustered(3000, 3, 2), SCHEMA))
    spread = hard_negatives.spread_of(table)
    blocks = hard_negatives.stash(hard_negatives.packed(hard_negatives.placed(table, spread), 16, ["vec_id", "label"], zones=True), "blocks")
    pages = hard_negatives.pages_of(blocks, 1)
    bound = [F.lit(x).cast("long").alias(c) for c, x in (("other", 0), ("lo", 150_000), ("hi", 2**63 - 1))]
    asked = table.where("vec_id % 1500 = 0").select("vec_id", "label", *bound, "v")
    chunks = hard_negatives.packed(hard_negatives.placed(asked, spread), 1, ["vec_id", "label", "other", "lo", "hi"], zones=False)
    needs = hard_negatives.choose(hard_negatives.stash(chunks, "windows"), 2, pages, 1, False, None)
    assert 0 < needs.count() < blocks.count()  # of two anchors


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    table = clustered(400, 4, 3)
    table += [(1000, None, 1, 1, "x", 2), (1100, [], 1, 1, "x", 2), (1200, [1.0, None, 0.0, 0.0], 1, 1, "x", 2), (1300, [nan] * 4, 1, 1, "x", 2), (1400, [inf] * 4, 1, 1, "x", 2), (None, [1.0] * 4, 1, 1, "x", 2), (1500, [0.0] * 4, 2, 1, "x", 2)]
    table += [(1600, [1.0, 2.0], 1, 1, "x", 2), (1601, [1.0, 1.0], 1, 1, "x", 2), (1602, [0.5, 0.5], 2, 1, "x", 2), (1700, [6e5, 4e5, 1.0, 0.0], 1, 1, "x", 2), (1701, [4e5, 4e5, 1.0, 0.0], 1, 1, "x", 2), (1702, [2e5, 2e5, 1.0, 0.0], 3, 1, "x", 2), (1800, [1.0] * 4, None, 1, "x", 2)]
    df = spark.createDataFrame(table, SCHEMA)
    assert sorted(rows(hard_negatives.mine(df))) == by_sql(df)
    assert sorted(rows(hard_negatives.mine(df.unionAll(df)))) == by_sql(df)
    assert rows(hard_negatives.mine(df.limit(0))) == []


def test_ties_go_to_smaller_ids(spark):
    table = [(i, [0.5, 0.25, 1.0], i % 3, 1, "x", 2) for i in range(300)] + [(300 + i, [0.25, 0.25, 0.5], i % 3, 1, "x", 2) for i in range(300)]
    df = spark.createDataFrame(table, SCHEMA)
    got = sorted(rows(hard_negatives.mine(df, block=32, chunk=4)))
    assert got == by_sql(df) and len(got) == 6 * 5 * 10
