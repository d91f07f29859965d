"""Line removal and conversation repair against brute force, and their odd cases."""

import hashlib
import heapq
import itertools
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import best_fit_packing, chat_paths, difference_shards, kneser_ney_toxicity, line_dedup, turn_repair, warc_chain

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def lines_by_hand(docs, least_chars=20, least_docs=3):
    holders = {}
    split = [(d, [x for x in (t or "").split("\n")]) for d, t in docs]
    key = lambda x: line_dedup.line_key(x.encode()).decode()
    for n, (d, lines) in enumerate(split):
        for k in {key(x) for x in lines if len(key(x)) >= least_chars}:
            holders.setdefault(k, {})[n] = d
    rows = []
    for d, lines in split:
        stay = []
        for x in lines:
            held = holders.get(key(x), {})
            top = max((i for i in held.values() if i is not None), default=None)
            if len(held) < least_docs or top == d:
                stay.append(x)
        rows.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(rows, key=str)


@pytest.mark.parametrize("held,shard", [(1 << 20, 1 << 16), (0, 8), (5, 4), (0, 1 << 16)])
def test_lines_against_brute_force(spark, held, shard):
    rng = random.Random(3)
    pool = [f"  Line {i} that IS long enough to count\t" for i in range(60)] + ["é" * 19, "é" * 20, "short", "", "\r", "\x00 nul characters are no white space"]
    docs = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 9)))) for i in range(150)]
    docs += [(None, pool[0]), (None, pool[1] + "\nonly here, and here alone"), (3, docs[3][1]), (7, None), (8, ""), (9, "x" * 2_000_000 + "\n" + pool[2].upper()), *[(None, "held by rows without an id alone")] * 3]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for given in (df, df.withColumns({"id": F.lit(1), "hi": F.lit("x"), "n": F.lit(2), "gone": F.lit(3), "n_lines": F.lit(4)})):
        got = sorted(map(tuple, line_dedup.dedup_lines(given, held=held, shard=shard).collect()), key=str)
        assert got == lines_by_hand(docs)


def test_lines_of_empty_tables_and_wrong_bounds(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup_lines(none).count() == 0 and line_dedup.dedup_lines(none, held=0).count() == 0
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(none, least_docs=1)


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        hi, lo = (rng.integers(-(1 << 63), (1 << 63) - 1, n) for _ in range(2))
        index = line_dedup.PerfectHash.build(hi, lo)
        assert sorted(index.place(hi, lo).tolist()) == list(range(n))
        assert len(index.words) * 64 <= 5 * n + 200
        assert ((index.place(lo, hi) >= -1) & (index.place(lo, hi) < max(n, 1))).all()


GRAMMAR = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def repair_by_hand(rows):
    """(cost, audit, lines) by a shortest-path search over (place, state); audits compared as strings."""
    seen, marks = set(), []
    for role, text in rows:
        inside = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not inside else "duplicate" if (role, text) in seen else "truncated" if inside[-1] not in ".!?" else ""
        seen.add((role, text))
        marks.append(fault)
    heap, done = [(0, "", 0, 0, ())], {}
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done and done[i, state] < (cost, audit):
            continue
        done[i, state] = cost, audit
        if i == len(rows) and state in (0, 3):
            return cost, audit, list(out), marks
        for role in ("user", "assistant"):
            if (state, role[0]) in GRAMMAR:
                heapq.heappush(heap, (cost + 3, audit + "I", i, GRAMMAR[state, role[0]], (*out, f"{role}:")))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
        if marks[i] in ("blank", "duplicate"):
            continue
        late = 3 * (marks[i] == "truncated")
        role, text = rows[i]
        if (state, role[:1]) in GRAMMAR:
            heapq.heappush(heap, (cost + late, audit + "K", i + 1, GRAMMAR[state, role[0]], (*out, f"{role}:{text}")))
        for new in ("user", "assistant"):
            if (state, new[0]) in GRAMMAR:
                heapq.heappush(heap, (cost + late + 3, audit + "R", i + 1, GRAMMAR[state, new[0]], (*out, f"{new}:{text}")))


def whole_row(turns, rows):
    cost, audit, lines, marks = repair_by_hand(rows)
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *[marks.count(x) for x in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def got_rows(spark, turns):
    repair = turn_repair.Repair(turns)
    digests = {r["ck"]: r["sha256"] for r in turn_repair.joined_digests(repair.repaired(), "ck", ["g", "k"], F.concat("role", F.lit(":"), "text")).collect()}
    out = {}
    for r in repair.report().collect():
        out[r["ck"]] = (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")], digests.get(r["ck"], hashlib.sha256().hexdigest()))
    return out


def sample(rng, n, roles=("system", "user", "assistant", "tool", " ")):
    return [(rng.choice(roles), rng.choice(["Yes.", "No!", "open", "", " \t", f"t{rng.randrange(n + 1)}?", f"more {rng.randrange(9)}"])) for _ in range(n)]


@pytest.mark.parametrize("segment,block", [(6, 10), (2, 1), (1, 2)])
def test_repairs_against_shortest_paths(spark, monkeypatch, segment, block):
    monkeypatch.setattr(turn_repair, "SEGMENT", segment)
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    rng = random.Random(5)
    data, turns = [], {}
    for conv in range(70):
        n = rng.choice([1, 2, 3, 5, 8, 17, 40])
        rows = sample(rng, n, ("user", "assistant") if conv % 3 == 0 else ("system", "user", "assistant", "tool", " "))
        at = sorted(rng.sample(range(3 * n), n))
        turns[str(conv)] = (at, rows)
        data += [(conv, t, *r) for t, r in zip(at, rows, strict=True)]
    rng.shuffle(data)
    got = got_rows(spark, spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(3))
    assert {k: whole_row(*v) for k, v in turns.items()} == got


def test_one_long_conversation_over_many_tasks(spark):
    rng = random.Random(7)
    rows = sample(rng, 700)
    data = [(1, t, *r) for t, r in enumerate(rows)] + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = got_rows(spark, spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == {"1": whole_row(list(range(700)), rows), "2": whole_row([0, 1], [("user", "Hi."), ("assistant", "Yes.")])}


def test_odd_turns(spark):
    data = [(None, None, None, None), (None, 3, "user", "b."), (4, 1, "user", "same."), (4, 1, "user", "same."), (4, None, "system", "x" * 300_000 + "."), (5, 2, "", "?"), (6, 9, "assistant", "\n \x0b")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    want = {"": whole_row([None, 3], [(" ", " "), ("user", "b.")]), "4": whole_row([None, 1, 1], [("system", "x" * 300_000 + "."), ("user", "same."), ("user", "same.")]), "5": whole_row([2], [("", "?")]), "6": whole_row([9], [("assistant", "\n \x0b")])}
    assert got_rows(spark, df) == want
    assert got_rows(spark, df.withColumns({"g": F.lit(1), "ck": F.lit(2), "n": F.lit("x"), "seg": F.lit(0), "code": F.lit(1)})) == want
    assert got_rows(spark, df.filter("false")) == {}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_op12(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        how = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if how == 1 else "".join(c for c in text if c not in ".!?") if how == 2 else text
        if how:
            after[conv] += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    got = {r["conv_id"]: tuple(r)[1:] for r in turn_repair.op12_turn_repair(spark, DATA).collect()}
    assert len(got) == len(after)
    for conv, turns in after.items():
        turns.sort()
        want = whole_row([t[0] for t in turns], [t[1:] for t in turns]) if turns else (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
        assert got[conv] == want


LARGER = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test data")
def test_op7_tells_toxic_texts_that_it_has_not_learned_from(spark):
    out = kneser_ney_toxicity.op7_kneser_ney_toxicity(spark, LARGER).filter("held_out").join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").select("toxic", "score", "predicted").collect()
    toxic, clean = ([r for r in out if r["toxic"] == c] for c in (1, 0))
    above = sum((t["score"] > c["score"]) + 0.5 * (t["score"] == c["score"]) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert above > 0.85 and sum(t["predicted"] for t in toxic) > 0.75 * len(toxic)
    assert sum(c["predicted"] for c in clean) < 0.01 * len(clean)


def test_clashing_columns_and_long_texts(spark, tmp_path):
    clash = lambda df: df.withColumns({c: F.lit(5) for c in ("id", "row", "half", "bytes", "hash", "label", "kind", "digest", "page", "offset", "payload", "node", "conv")})
    long = "calm words of a text that goes on and on. " * 25_000
    docs = spark.createDataFrame([(i, ("nasty slurry blight " if i % 3 == 0 else "calm words of a text ") * 9, i % 3 == 0) for i in range(900)] + [(1000, long, False), (1001, None, True)], "doc_id long, text string, t boolean")
    labels = docs.select("doc_id", F.col("t").cast("int").alias("toxic")).unionByName(spark.createDataFrame([(3, None), (None, 1)], "doc_id long, toxic int"))
    rows = lambda df: sorted(map(str, df.collect()))
    got = rows(kneser_ney_toxicity.score_toxicity(docs.drop("t"), labels))
    assert len(got) == 902 and got == rows(kneser_ney_toxicity.score_toxicity(clash(docs.drop("t")), clash(labels)))
    marked = {r["doc_id"]: r["predicted"] for r in kneser_ney_toxicity.score_toxicity(docs.drop("t"), labels).collect()}
    assert marked[0] == 1 and marked[1] == marked[1000] == marked[1001] == 0
    pages = spark.createDataFrame([(1, "u", long), (2, "u", long), (3, None, None), (None, "v", "x")], "page_id long, url string, html string")
    for n, given in enumerate((pages, clash(pages))):
        warc_chain.write_warc(given, f"{tmp_path}/w{n}")
    back = [sorted(map(str, warc_chain.verified_records(spark, f"{tmp_path}/w{n}").drop("path", "file", "at", "offset", "begin", "finish").collect())) for n in (0, 1)]
    assert len(back[0]) == 4 and len(back[1]) == 4
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")
    assert chat_paths.read_back(chat_paths.format_paths(chat_paths.linear_tree(turns))).first()["loss_text"] == long


def test_shards_of_ties_and_rows_without_ids(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (1, "b"), (1, "c"), (2, None), (3, ""), (4, "x" * 100_000)] + [(10 + i, f"t{i % 40:02d}") for i in range(400)], "doc_id long, text string")
    out = difference_shards.shard_documents(docs, 8).toPandas()
    assert len(out) == 407 and out["doc_id"].isna().sum() == 2
    assert all(sorted(g) == list(range(len(g))) for _, g in out.groupby("shard")["slot"])
    totals = out.groupby("shard")["size"].sum().sort_values()
    assert totals.iloc[-1] == 100_001 and totals.iloc[-2] - totals.iloc[0] <= 40  # the long text alone, the others even
    again = difference_shards.shard_documents(docs, 8).toPandas()
    assert sorted(map(str, again.itertuples(index=False))) == sorted(map(str, out.itertuples(index=False)))


def test_packing_odd_rows_and_tiny_exhaustive(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    path = tokenizers.path("word_bpe_49k.json")
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "a b"), (2, "a b")], "doc_id long, text string").withColumns({"length": F.lit("x"), "piece": F.lit(9), "sequence_id": F.lit(1)})
    out = best_fit_packing.best_fit_packing(odd, path).toPandas()
    assert len(out) == 4 and out["sequence_id"].nunique() == 1 and sorted(out["length"]) == [1, 1, 3, 3]
    assert best_fit_packing.best_fit_packing(odd.filter("false"), path).count() == 0
    # As few sequences as any packing needs, on inputs small enough to try all.
    rng = random.Random(4)
    for _ in range(4):
        docs = [(i, "a " * rng.randrange(1, 11)) for i in range(7)]
        got = best_fit_packing.best_fit_packing(spark.createDataFrame(docs, "doc_id long, text string"), path, capacity=12).toPandas()
        sizes = got["length"].tolist()

        def fewest(left, bins):
            if not left:
                return len(bins)
            best = len(bins) + len(left)
            for k in range(len(bins)):
                if bins[k] + left[0] <= 12:
                    best = min(best, fewest(left[1:], [*bins[:k], bins[k] + left[0], *bins[k + 1 :]]))
            return min(best, fewest(left[1:], [*bins, left[0]]))

        assert got["sequence_id"].nunique() <= fewest(sorted(sizes, reverse=True), []) + 1
        assert (got.groupby("sequence_id")["length"].sum() <= 12).all()
