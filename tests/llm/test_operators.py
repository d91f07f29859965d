"""Training-data operators against brute force, exact round trips and their odd cases."""

import base64
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import best_fit_packing, chat_paths, common, difference_shards, exact_dedup, fragment_join, kernel_language, kneser_ney_toxicity, multi_index, piece_codec, warc_chain

tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, lang string, source string, keep_id long"
ODD = [(1, None, "en", "x", 9), (2, "", "en", "x", 9), (3, "   \n", None, "x", 9), (4, "word " * 3000, "en", None, 9), (5, "ÉÀ naïve — 日本 ▁▁ x", "fr", "x", 9), (5, "ÉÀ naïve — 日本 ▁▁ x", "fr", "x", 9), (None, "a b", "en", "x", 9), (7, "A B", "en", "x", 9)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def prose(rng, n):
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 7))) for _ in range(40)]
    return [" ".join(rng.choices(words, k=n)) for _ in range(1)][0]


@pytest.mark.parametrize("hasher", [exact_dedup.content_hash, lambda x: bytes([zlib.crc32(x) % 3]) * 16])
def test_exact_dedup_even_with_collisions(spark, odd, hasher):
    rows = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(odd, keep="max", hasher=hasher).collect()}
    assert rows == {(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 2, True), (None, 7, 2, False), (7, 7, 2, True)}


def test_exact_dedup_empty(none):
    assert exact_dedup.exact_dedup(none).count() == 0


def tree(spark):
    rows = [(1, 1, None, 0.0, "user", "</s>[INST] \\ <"), (1, 2, 1, 0.5, "assistant", "[x]"), (1, 3, 1, 0.9, "assistant", "b"), (1, 4, 3, 0.0, None, None), (2, 1, None, 0.0, "user", "only")]
    return spark.createDataFrame(rows, "conv long, node long, parent long, score double, role string, text string").fillna("", ["role", "text"])


def test_chat_paths(spark):
    paths = {(r["conv"], r["leaf"], r["node"], r["up"]) for r in chat_paths.root_to_leaf_paths(tree(spark)).collect()}
    assert paths == {(1, 2, 2, 0), (1, 2, 1, 1), (1, 4, 4, 0), (1, 4, 3, 1), (1, 4, 1, 2), (2, 1, 1, 0)}
    out = chat_paths.format_paths(tree(spark), best=2)
    assert {(r["conv"], r["rank"]): r["leaf"] for r in out.collect()} == {(1, 1): 4, (1, 2): 2, (2, 1): 1}
    back = {r["conv"]: r for r in chat_paths.read_back(out.filter("rank = 1")).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("user", "</s>[INST] \\ <"), ("assistant", "b"), ("", "")]
    assert back[1]["loss_text"] == "b" and back[2]["loss_text"] == ""
    assert "</s>" not in back[1]["formatted"].split("[/ROLE]")[1].removesuffix("</s><s>[ROLE]assistant")


def test_reply_cycles_are_on_no_path(spark):
    rows = [(1, 1, 2, "a"), (1, 2, 1, "b"), (1, 3, 2, "leaf of a cycle"), (1, 4, None, "root"), (1, 5, 4, "leaf"), (2, 1, 1, "its own parent")]
    nodes = spark.createDataFrame([(c, n, p, 0.0, "user", t) for c, n, p, t in rows], "conv long, node long, parent long, score double, role string, text string")
    assert {(r["conv"], r["leaf"], r["node"]) for r in chat_paths.root_to_leaf_paths(nodes).collect()} == {(1, 5, 5), (1, 5, 4)}


def jaccard_groups(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        o = len(sets[i] & sets[j])
        if o and 100 * o >= 80 * (len(sets[i]) + len(sets[j]) - o):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), k), k)
    return {rows[i][0]: (len(sets[i]), low[find(i)]) for i in range(len(rows))}


def test_jaccard_against_brute_force(spark, none):
    rng = random.Random(3)
    rows, base = [], [prose(rng, rng.choice([3, 5, 12, 60, 200])).split() for _ in range(12)]
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "".join(rng.choices("XYZ", k=4))
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(1000, None), (1001, ""), (1002, " \t"), (1003, "one two"), (1004, "ONE two")]
    rng.shuffle(rows)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in fragment_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == jaccard_groups(rows)
    assert fragment_join.jaccard_components(none).count() == 0


def test_jaccard_links_null_and_repeated_ids(spark):
    rng = random.Random(8)
    base = [prose(rng, 60) for _ in range(4)]
    near = lambda k, *ends: [f"{base[k]} {end}" for end in ends]
    rows = [(None, near(0, "a")[0]), (None, near(0, "b")[0]), (5, near(0, "c")[0]), (9, near(0, "d")[0])]  # named by 5
    rows += [(None, x) for x in near(1, "a", "b", "b")]  # no id at all
    rows += [(7, near(2, "a")[0]), (7, near(3, "a")[0]), (8, near(2, "b")[0]), (6, near(3, "b")[0])]  # one id, two texts
    rows += [(None, "alone without an id"), (None, "")]
    expected = [5] * 4 + [None] * 3 + [7, 6, 7, 6] + [None] * 2
    got = fragment_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r["doc_id"], r["component_id"]) for r in got.collect()), key=str) == sorted(((k, c) for (k, _), c in zip(rows, expected, strict=True)), key=str)


def test_language(spark, odd, none):
    rows = [(i, ("the and of with there " if i % 2 else "der und von mit nicht ") * (1 + i % 5), "en" if i % 2 else "de") for i in range(60)]
    docs = spark.createDataFrame([*rows, (100, "1234 ...", "en"), (101, None, "en")], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in kernel_language.identify_language(docs).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows)
    assert got[100]["lang_pred"] == got[101]["lang_pred"] == "und" and got[100]["score"] == 0
    assert kernel_language.identify_language(odd).count() == len(ODD) and kernel_language.identify_language(none).count() == 0


def test_every_language_can_be_predicted(spark):
    rng, rows = random.Random(7), []
    for n in range(120):
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        rows += [(3 * n + i, " ".join(rng.choices(words, k=40)), f"l{n:03d}") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in kernel_language.identify_language(docs).collect()}
    assert set(got.values()) == {lang for _, _, lang in rows}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.98 * len(rows)


def test_very_long_text(spark):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(3000)]
    long = " ".join(rng.choices(words, k=220_000))  # 1.3 MB
    docs = spark.createDataFrame([(1, long, "en"), (2, long + " end", "en"), (3, "short one", "en")], "doc_id long, text string, lang string")
    assert {r["keep_id"] for r in exact_dedup.exact_dedup(docs).collect()} == {1, 2, 3}
    assert {(r["doc_id"], r["component_id"]) for r in fragment_join.jaccard_components(docs).collect()} == {(1, 1), (2, 1), (3, 3)}
    assert kernel_language.identify_language(docs).count() == 3
    assert difference_shards.shard_documents(docs).agg(F.max("size")).first()[0] == len(long) + 5
    got = {r["doc_id"]: r for r in piece_codec.piece_digests(docs, tokenizers.path("piece_bpe_32k.model")).collect()}
    assert got[1]["decoded_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    out = best_fit_packing.best_fit_packing(docs, tokenizers.path("word_bpe_49k.json")).toPandas()
    assert (out[out["doc_id"] == 1].sort_values("piece")["length"].to_numpy()[:-1] == 2048).all()


def test_piece_codec_equals_library():
    import sentencepiece

    path = tokenizers.path("piece_bpe_32k.model")
    model, codec = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.PieceCodec(path)
    rng = random.Random(1)
    texts = ["", " ", "  a", "a  ", "a ", "a b ", "a▁", "▁", "▁▁a b▁", "<s></s><unk> x", "日本語 テキスト", "\n\t", " x y", "é", *("".join(rng.choices("ab é▁\n<s>日́ ", k=30)) for _ in range(200))]
    for text in texts:
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert codec.encode(text) == ids
        assert codec.decode(codec.encode(text)) == model.decode(ids)


def test_piece_digests(odd, none):
    path = tokenizers.path("piece_bpe_32k.model")
    got = {r["doc_id"]: r for r in piece_codec.piece_digests(odd, path).collect()}
    assert got[1]["n_tokens"] == got[2]["n_tokens"] == 2 and got[1]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert piece_codec.piece_encode(none, path).count() == 0


def test_piece_blocks_equal_library(spark, monkeypatch):
    import sentencepiece

    monkeypatch.setattr(piece_codec, "BLOCK", 500)  # many blocks
    path = tokenizers.path("piece_bpe_32k.model")
    model, rng = sentencepiece.SentencePieceProcessor(model_file=path), random.Random(6)
    texts = [None, "", " ", "one", "x" * 5000, *("".join(rng.choices("ab é▁\n<s>日́ ", k=rng.randrange(60))) for _ in range(150)), "word again " * 400]
    rows = [(None if i % 7 == 0 else i // 2, t) for i, t in enumerate(texts)]
    for parts in (1, 3):
        got = piece_codec.piece_encode(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts), path).collect()
        want = []
        for i, t in rows:
            ids = model.encode(t or "", add_bos=True, add_eos=True)
            want.append((i, np.array(ids, dtype="<u4").tobytes(), model.decode(ids)))
        assert sorted(((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in got), key=str) == sorted(want, key=str)


def test_piece_codec_of_another_model(spark, monkeypatch):
    path = tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame([(1, "some words"), (None, None), (1, " other  words")], "doc_id long, text string")
    before = sorted(map(str, piece_codec.piece_digests(docs, path).collect()))
    init = piece_codec.PieceCodec.__init__
    monkeypatch.setattr(piece_codec.PieceCodec, "__init__", lambda self, file: (init(self, file), setattr(self, "separable", False))[0])
    assert sorted(map(str, piece_codec.piece_digests(docs, path).collect())) == before


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 16)).astype(np.float32)
    x[7] = x[8]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(1000, None), (1100, [0.0] * 16), (1200, [float("nan")] + [1.0] * 15), (1300, [1.0]), (1400, [None] + [1.0] * 15)]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<float>")
    got = multi_index.nearest_neighbours(df, "id % 100 = 0", centroids=8).collect()
    assert {r["query_id"] for r in got} == {0, 100, 200, 300}
    hits = 0
    for q in (0, 100, 200, 300):
        d = np.sqrt(((x.astype(np.float64) - x[q].astype(np.float64)) ** 2).sum(1))
        true = [i for i in np.lexsort((np.arange(400), d)) if i != q][:10]
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [r[0] for r in own] == list(range(1, 11)) and all(abs(s - d[i]) < 1e-12 for _, i, s in own)
        hits += len({i for _, i, _ in own} & set(true))
    assert hits >= 36
    assert multi_index.nearest_neighbours(spark.createDataFrame(bad, "vec_id long, embedding array<float>"), "true").count() == 0


def test_toxicity(spark, odd, none):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(300):
        words = prose(rng, rng.randrange(10, 60)).split()
        if toxic := i % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "zork" + rng.choice(["s", "ed", "ing", "ish"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in kneser_ney_toxicity.score_toxicity(docs, marks, train="id % 3 <> 0").collect()}
    held = [i for i in range(0, 300, 3)]
    assert sum(got[i]["predicted"] == int(i % 5 == 0) for i in held) >= 97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert kneser_ney_toxicity.score_toxicity(odd, marks).count() == len(ODD)
    assert kneser_ney_toxicity.score_toxicity(none, marks).count() == 0


def plain_ratio(word, counts):
    """The log-likelihood ratio of an expression under Kneser-Ney models kept in dictionaries: counts[c] by word."""
    n, order = kneser_ney_toxicity, kneser_ney_toxicity.ORDER
    grams = lambda w: [(chr(n.START) * (order - 1) + w + chr(n.END))[i : i + order] for i in range(len(w) + 1)]
    tables = []
    for held in counts:
        table = {}
        for w, times in held.items():
            for g in grams(w):
                table[g] = table.get(g, 0) + times
        tables.append(table)
    both = {g: tables[0].get(g, 0) + tables[1].get(g, 0) for g in tables[0] | tables[1]}
    levels = [both]
    while len(next(iter(levels[-1]))) > 1:
        shorter = {}
        for g in levels[-1]:
            shorter[g[1:]] = shorter.get(g[1:], 0) + 1
        levels.append(shorter)

    def shared(g, level=0):
        same = [c for x, c in levels[level].items() if x[:-1] == g[:-1]]
        below = shared(g[1:], level + 1) if len(g) > 1 else 1 / n.ALPHABET
        return (max(levels[level].get(g, 0) - n.DISCOUNT, 0) + n.DISCOUNT * len(same) * below) / sum(same)

    total = 0.0
    for g in grams(word):
        logs = []
        for table in tables:
            same = [c for x, c in table.items() if x[:-1] == g[:-1]]
            spare = sum(min(c, n.CLASS_DISCOUNT) for c in same) / sum(same) if same else 1.0
            own = max(table.get(g, 0) - n.CLASS_DISCOUNT, 0) / sum(same) if same else 0.0
            # The shared likelihood of an n-gram that no class holds is the same for both.
            logs.append(np.log(own + spare * shared(g)) if g in both else np.log(spare))
        total += logs[1] - logs[0]
    return total if abs(total) >= n.EVIDENCE else 0.0


def test_toxicity_models_against_brute_force():
    words = ["zork", "zorks", "zorked", "the", "thesis", "a", "dog", "dork"]
    toxic, ordinary = 20 * np.array([30, 12, 9, 40, 1, 20, 0, 3]), 20 * np.array([0, 1, 0, 41, 12, 22, 18, 2])
    model = kneser_ney_toxicity.ClassModels(words, toxic, ordinary)
    again = kneser_ney_toxicity.ClassModels.unpacked(model.packed())
    counts = [{w: int(c) for w, c in zip(words, x, strict=True) if c} for x in (ordinary, toxic)]
    asked = [*words, "zorking", "theses", "qqq", "z"]
    want = [plain_ratio(w, counts) for w in asked]
    assert np.allclose(model.ratios(asked), want, atol=1e-4) and np.allclose(again.ratios(asked), want, atol=1e-4)
    assert want[0] > kneser_ney_toxicity.EVIDENCE and want[3] == 0


def test_shards(spark, none):
    rng = random.Random(4)
    rows = [(i, "x" * rng.choice([0, 1, 5, 50, rng.randrange(3000)])) for i in range(3000)] + [(5000 + i, "y" * 40_000) for i in range(3)] + [(6000, None)]
    out = difference_shards.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), bucket=300, last=1000).toPandas()
    text = dict(rows)
    out["text"] = out["doc_id"].map(text).fillna("")
    assert len(out) == len(rows) and out.groupby("text")["shard"].nunique().max() == 1
    totals = out.groupby("shard")["size"].sum()
    heavy = out.groupby("text")["size"].sum().max()
    assert totals.max() == heavy or totals.max() - totals.min() <= 0.001 * totals.mean()
    assert all(sorted(g) == list(range(len(g))) for _, g in out.groupby("shard")["slot"])
    assert difference_shards.shard_documents(none).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    histogram = {}
    for _ in range(rng.choice([1, 30, 2000])):
        n = rng.randrange(1, capacity + 1) if seed % 2 else min(capacity, 1 + int(rng.expovariate(6 / capacity)))
        histogram[n] = histogram.get(n, 0) + 1
    plan = best_fit_packing.plan_packing(histogram, capacity)
    bins: dict[int, list[tuple[int, int]]] = {}
    for n, c in histogram.items():
        rows = plan[plan["length"] == n].sort_values("rank").to_dict("records")
        for r in range(c):
            row = [x for x in rows if x["rank"] <= r][-1]
            k = r - row["rank"]
            bins.setdefault(row["sequence"] + k // row["each"], []).append((row["offset"] + k % row["each"] * n, n))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity
    total = sum(n * c for n, c in histogram.items())
    assert len(bins) <= 1.25 * total / capacity + 1 + sum(c for n, c in histogram.items() if 2 * n > capacity)


def test_packing_round_trip(spark, odd, none):
    from tokenizers import Tokenizer

    path = tokenizers.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    codec, rng = best_fit_packing.WordCodec(path), random.Random(9)
    texts = ["", "Don't STOP, it's 12½ µm!", "İstanbul ΑΣ ὈΔΥΣΣΕΎΣ", "áb <|endoftext|>", *("".join(rng.choices("aB'st re2½_-. \n \x85é日́Σ", k=40)) for _ in range(300))]
    for text in texts:
        assert codec.encode(text) == np.array(model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text
    got = best_fit_packing.best_fit_packing(odd, path).toPandas().sort_values(["doc_id", "piece"])
    assert got[got["doc_id"] == 1]["length"].tolist() == [1] and got[got["doc_id"] == 4]["length"].tolist() == [2048, 953]
    assert best_fit_packing.best_fit_packing(none, path).count() == 0


def test_packing_matches_added_tokens_in_raw_text(spark):
    from tokenizers import Tokenizer

    path, rng = tokenizers.path("word_bpe_49k.json"), random.Random(4)
    model = Tokenizer.from_file(path)
    codec = best_fit_packing.WordCodec(path, special=True)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof text|>", "<|", "|>", "a", "B's", " ", "\n", "\x85", "\xa0", "é", "日本", "12", "Σ", "\u0301"]
    texts = ["a <|endoftext|> b", "a<|endoftext|>b", *("".join(rng.choices(parts, k=12)) for _ in range(400))]
    for text in texts:
        assert codec.encode(text) == np.array(model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text
    got = best_fit_packing.best_fit_packing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    crc = lambda text: zlib.crc32(np.array([*model.encode(text, add_special_tokens=False).ids, 0], dtype="<u4").tobytes())
    assert {r["doc_id"]: r["ids_crc32"] for r in got} == {i: crc(text) for i, text in enumerate(texts)}


def test_another_tokenizer_file_goes_to_the_library(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        said = json.load(file)
    said["normalizer"] = {"type": "NFC"}  # letters keep their case
    (tmp_path / "other.json").write_text(json.dumps(said), encoding="utf-8")
    path = str(tmp_path / "other.json")
    assert best_fit_packing.separable(tokenizers.path("word_bpe_49k.json")) and not best_fit_packing.separable(path)
    codec, model = best_fit_packing.WordCodec(path, special=True), Tokenizer.from_file(path)
    for text in ("Don't STOP at É 12", "", "a <|endoftext|> B"):
        assert codec.encode(text) == np.array(model.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_warc_with_magic_inside_payloads(spark, tmp_path):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    rows = [(1, "http://a", "plain"), (2, None, None), (3, "u", f"x {inner}{inner} y"), (4, "u", "plain"), (5, "u", "WARC/1.1\r\nWARC/1.1\r\n"), (6, "u", inner), (7, "u", "é" * 5000), *[(100 + i, "u", f"page {i} " * 50) for i in range(50)]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # splits inside records
    try:
        warc_chain.write_warc(df, str(tmp_path / "w"))
        got = {r["page"]: r for r in warc_chain.verified_records(spark, str(tmp_path / "w")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        if page == 4:
            assert got[4]["kind"] == "revisit" and got[4]["refers_to"] == 1 and got[4]["payload_bytes"] == 0 and got[4]["stated_bytes"] == 5
        else:
            assert got[page]["kind"] == "response" and got[page]["payload_bytes"] == len(raw) and got[page]["digest"] == got[page]["stated"]


def test_warc_null_page_id_inside_a_file(spark, tmp_path):
    rows = [(1, "u", "first"), (None, "u", "without id"), (2, "u", "second"), (None, None, None), (3, "u", "third")]
    warc_chain.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    got = [(r["page"], r["kind"], r["payload_bytes"], r["digest"] == r["stated"]) for r in warc_chain.verified_records(spark, str(tmp_path / "w")).collect()]
    assert sorted(got, key=str) == sorted(((page, "response", len(html or ""), True) for page, _, html in rows), key=str)


def test_warc_page_id_with_several_payloads(spark, tmp_path):
    rows = [(5, "A"), (5, "B"), (3, "B"), (7, "C"), (7, "D"), (4, "C"), (6, "D"), (3, "B"), (None, "B"), (None, "E"), (None, "E")]
    pages = spark.createDataFrame([(page, "u", html) for page, html in rows], "page_id long, url string, html string")
    warc_chain.write_warc(pages, str(tmp_path / "w"))
    got = [(r["page"], r["kind"], r["refers_to"], r["stated"]) for r in warc_chain.verified_records(spark, str(tmp_path / "w")).collect()]
    first = {"A": 5, "B": 3, "C": 4, "D": 6}
    expected = []
    for page, html in rows:
        digest = base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        expected.append((page, "response", None, digest) if first.get(html) in (page, None) else (page, "revisit", first[html], digest))
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_key_bitmap(spark):
    keys = spark.range(0, 1000, 7).select(F.xxhash64("id").alias("k"))
    bits = common.key_bitmap(keys, "k", 16)
    have = np.array([r["k"] for r in keys.collect()])
    assert common.in_bitmap(bits, have).all() and bits.size == 1024


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    data = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "exact dedup", "near dedup", "packing"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns and out.count() >= 0.8 * docs.count(), name
        docs = common.cut(out, "test")


def test_pipeline_decides_on_rows(spark, tmp_path):
    import corpus_pipeline

    text = prose(random.Random(5), 60)
    rows = [(1, "!!! 12", "en"), (1, "clean words", "en"), (None, "... 3", "en"), (None, "other words", "en"), (None, "other words", "en"), (None, f"{text} a", "en")]
    rows += [(2, f"{text} b", "en"), (2, f"{text} b", "en"), (3, "clean words", "en"), (None, f"{text} c", "de"), (4, "", "en")]
    docs = spark.createDataFrame([(*row, "x", len(row[1])) for row in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents"))
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    for given in (docs, spark.read.parquet(str(tmp_path / "documents"))):
        lettered = common.cut(stages["language"](spark, given, ""), "test")
        assert kept(lettered) == sorted(((k, t) for k, t, _ in rows if any(map(str.isalpha, t))), key=str)
        apart = common.cut(stages["exact dedup"](spark, lettered, ""), "test")
        assert kept(apart) == sorted([(1, "clean words"), (None, "other words"), (None, f"{text} a"), (2, f"{text} b"), (None, f"{text} c")], key=str)
        assert kept(stages["near dedup"](spark, apart, "")) == sorted([(1, "clean words"), (None, "other words"), (2, f"{text} b")], key=str)


def test_toxic_rows_go_alone(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    texts = [prose(rng, 30) + (" zorked zorks zorking" if i % 5 == 0 else "") for i in range(300)]
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = [*enumerate(texts), (None, texts[0]), (None, texts[1]), (1001, texts[5]), (1001, texts[6])]
    docs = spark.createDataFrame([(k, t, "en", "x", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()]
    assert (None, texts[1]) in kept and (None, texts[0]) not in kept and (1001, texts[6]) in kept and (1001, texts[5]) not in kept


def test_language_stage_without_labels(spark):
    import corpus_pipeline

    rows = [(1, "clean words"), (2, "... 3"), (3, None), (None, "日本")]
    docs = spark.createDataFrame([(k, t, None, "x", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["text"] for r in corpus_pipeline.drop_unidentified(spark, docs, "").collect()} == {"clean words", "日本"}
