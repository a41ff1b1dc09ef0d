"""The corpus operators against plain-Python statements of what they give, with edge rows."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from turnloom.llm import (
    bpe,
    chat_format,
    decontaminate,
    exact_dedup,
    gru,
    license_scan,
    lm_score,
    personal_data,
    quality,
    simhash_dedup,
    token_files,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))

VOCABULARY = "the of and that with ou erth onsh née über niño it's 42 x1 re, in. THE".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp long, row string, score string"


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "a", "b", "ing"]) for _ in range(n))


def rows_with_edges(seed=1, n=40):
    """Texts with NULLs, empties, a very long one, copies, near copies and repeated rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.randint(1, 60)) for _ in range(n)]
    texts += [None, "", "   \n", "x" * 5_000, prose(rng, 6_000), texts[0], texts[0], texts[1] + " end", "ẞ 本 \U0001f600 <|endoftext|> a\x1cb"]
    rows = [(i, t, "en", "s", None, "no", 7, "r", None) for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, "no id", None, None, None, None, None, None, None), (None, texts[2], *[None] * 7)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_with_edges(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def given():
    return [(r[0], r[1] or "") for r in rows_with_edges()]


# --- exact dedup -----------------------------------------------------------


def test_cuckoo_index_inserts_deletes_and_grows():
    index, live = exact_dedup.CuckooIndex(buckets=2), {}
    rng = random.Random(3)
    for i in range(4_000):
        key = hashlib.sha256(str(rng.randrange(1_500)).encode()).digest()
        assert index.find(key) == live.get(key)
        if key in live and rng.random() < 0.5:
            index.delete(key)
            del live[key]
        elif key not in live:
            index.insert(key, i)
            live[key] = i
    assert dict(index.items()) == live and len(index) == len(live) and index.resizes > 0


@pytest.mark.parametrize("keys", [1, 3, exact_dedup.INDEX_KEYS])
def test_exact_dedup(docs, empty, keys):
    """Indexes of any size give the same rows."""
    found = exact_dedup.exact_dedup(docs, carry=docs.columns, index_keys=keys).collect()
    best, size = {}, Counter()
    for i, t in given():
        size[t] += 1
        best[t] = max((x for x in (best.get(t), i) if x is not None), default=None)
    assert len(found) == len(given())
    kept = Counter()
    for r in found:
        t = r.row.text or ""
        assert (r.keep_id, r.group_size) == (best[t], size[t])
        assert r.text_sha256 == hashlib.sha256(t.encode()).hexdigest()
        assert not r.kept or r.id == best[t]
        kept[t] += r.kept
    assert set(kept.values()) == {1}
    assert exact_dedup.keep_one_of_equal_texts(docs).columns == docs.columns
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_one_text_a_hundred_thousand_times(spark):
    many = spark.range(100_000).selectExpr("id AS doc_id", "if(id % 3 = 0, concat('text ', id), 'the same') AS text")
    found = exact_dedup.exact_dedup(many.repartition(6), index_keys=500)
    by_size = {r.group_size: (r.n, r.kept) for r in found.groupBy("group_size").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()}
    assert by_size == {1: (33_334, 33_334), 66_666: (66_666, 1)}
    assert found.filter("kept AND group_size > 1").first().id == 99_998


# --- SimHash ---------------------------------------------------------------


def plain_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(values, budget):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= budget and label[j] > label[i]:
                    label[j], changed = label[i], True
    return label


@pytest.mark.parametrize("lead", [0, 12])
def test_trie_join_finds_every_link(lead):
    rng = random.Random(lead)
    values = set()
    for _ in range(12):
        head, center = rng.getrandbits(lead) if lead else 0, rng.getrandbits(64 - lead)
        for _ in range(12):
            flipped = center
            for _ in range(rng.randint(0, 5)):
                flipped ^= 1 << rng.randrange(64 - lead)
            values.add(head << (64 - lead) | flipped)
    keys = np.array(sorted(values), np.uint64)
    heads = keys >> np.uint64(64 - lead) if lead else np.zeros(len(keys), np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
    ends = np.concatenate((starts[1:], [len(keys)]))
    label = simhash_dedup.trie_groups(keys, starts, ends, lead, 4)
    for a, b in zip(starts, ends):
        want = plain_groups([int(k) for k in keys[a:b]], 4)
        assert [int(x) - a for x in label[a:b]] == want


def test_simhash_components(docs, empty):
    found = simhash_dedup.simhash_components(docs).collect()
    prints = {t: plain_fingerprint(t) for _, t in given()}
    assert Counter((r.id, r.fp % 2**64) for r in found) == Counter((i, prints[t]) for i, t in given())
    values = sorted(set(prints.values()))
    group = dict(zip(values, plain_groups(values, 4)))
    least = {}
    for i, t in given():
        g = group[prints[t]]
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    for r in found:
        assert r.component_id == least[group[r.fp % 2**64]]
    assert simhash_dedup.simhash_components(empty).count() == 0
    left = simhash_dedup.keep_one_of_each_component(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} >= set(least.values())


def test_long_chains_become_one_component(spark):
    chain = spark.range(200).selectExpr("id + 1 AS a", "id AS b")
    rows = simhash_dedup.components(chain).collect()
    assert len(rows) == 200 and {r.root for r in rows} == {0}


# --- BPE -------------------------------------------------------------------


def test_bpe_equals_the_library(docs, empty):
    library = tokenizers.Tokenizer.from_file(BYTES)
    want = Counter()
    for i, t in given():
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.round_trip_digests(docs, BYTES).collect())) == want
    texts = bpe.decode_documents(bpe.encode_documents(docs, BYTES), BYTES)
    assert Counter(map(tuple, texts.collect())) == Counter(given())
    assert bpe.encode_documents(empty, BYTES).count() == 0


def test_tree_merges_leftmost_lowest_rank():
    rng = random.Random(9)
    rules = [(rng.randrange(6), rng.randrange(6), 6 + i) for i in range(12)] + [(6, 6, 18), (7, 1, 19)]
    ranks = bpe.PairRanks(rules)
    rows = [[rng.randrange(6) for _ in range(rng.randint(1, 40))] for _ in range(300)]

    def plain(symbols):
        symbols = symbols[:]
        while True:
            pairs = [(ranks.ranks.get(a << bpe.SYMBOL_BITS | b), i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
            pairs = [p for p in pairs if p[0] is not None]
            if not pairs:
                return symbols
            rank, i = min(pairs)
            symbols[i : i + 2] = [ranks.merged[rank]]

    want = [plain(r) for r in rows]
    assert [bpe.merge_symbols(r, ranks.ranks, ranks.merged) for r in rows] == want
    flat = np.array([s for r in rows for s in r])
    assert [list(r) for r in ranks.merge_rows(np.array([len(r) for r in rows]), flat)] == want


# --- token files -----------------------------------------------------------


def test_wavelet_matrix_answers():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 90, 3_000).astype(np.uint16)
    matrix = token_files.WaveletMatrix.build(ids, 7)
    assert (matrix.decode() == ids).all()
    assert all(matrix.access(i) == ids[i] for i in range(0, 3_000, 17))
    for token in (0, 5, 89, 127, 200):
        places = np.flatnonzero(ids == token)
        assert matrix.count(token) == len(places)
        assert matrix.count(token, 100, 900) == (ids[100:900] == token).sum()
        assert all(matrix.select(token, k) == places[k] for k in range(0, len(places), 5))
    with pytest.raises(IndexError):
        matrix.select(127, 0)


@pytest.mark.parametrize("shard_ids", [1 << 23, 200])
def test_token_files_read_back(spark, docs, empty, tmp_path, shard_ids):
    library = tokenizers.Tokenizer.from_file(WORDS)
    path = str(tmp_path / "shards")
    token_files.write_shards(docs, path, WORDS, end_id=2, ranges=3, shard_ids=shard_ids)
    found = sorted(token_files.read_documents(spark, path).collect(), key=lambda r: r.start)
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
    ids = [r.id for r in found]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:])
    coded = lambda t: np.array(library.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes()
    assert Counter((r.id, r.ids_crc32) for r in found) == Counter((i, zlib.crc32(coded(t))) for i, t in given())
    token_files.write_shards(empty, str(tmp_path / "none"), WORDS, end_id=2, ranges=2)
    assert token_files.read_documents(spark, str(tmp_path / "none")).count() == 0


# --- decontamination and licenses ------------------------------------------


def plain_words(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def plain_shingles(text):
    words = plain_words(text)
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def test_leaks_match_brute_force(spark):
    rng = random.Random(4)
    long = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    items = [(0, long(30)), (1, long(60)), (2, long(14)), (3, "four words only here"), (4, None), (None, long(20)), (5, long(40))]
    one, two, five = items[0][1], items[1][1].split(), items[6][1]
    texts = [
        long(50) + " " + one.upper().replace(" ", "!! ") + " " + long(20),
        " ".join([*two[:29], "changed", *two[30:]]) + " " + long(9),
        " ".join(two[:40]) + " " + long(30),
        long(400),
        None,
        "",
        one + " " + one + " " + five,
        " ".join(items[2][1].split()[1:]) + " " + long(5),
        "four words only here",
    ]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, texts[0], "x"), (None, texts[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    table = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for d, t, _ in rows:
        for i, item in items:
            whole, n = Counter(plain_shingles(item or "")), len(plain_shingles(item or ""))
            shingles = plain_shingles(t or "")
            for p in range(len(shingles) if n and i is not None else 0):
                window = shingles[p : p + n]
                shared = sum((Counter(window) & whole).values())
                if shared / (len(window) + n - shared) >= 0.8:
                    want[d, i] = max(want.get((d, i), 0), shared / (len(window) + n - shared))
    found = decontaminate.leaks(docs, table).collect()
    assert {(r.id, r.item_id): pytest.approx(r.similarity) for r in found} == want and len(found) == len(want)
    assert {(0, 0), (1, 1), (6, 0), (6, 5)} <= set(want) and (2, 1) not in want
    clean = decontaminate.drop_leaks(docs, table)
    assert {r.doc_id for r in clean.collect()} == {d for d, _, _ in rows} - {d for d, _ in want if d is not None}
    assert decontaminate.leaks(docs.limit(0), table).count() == 0
    assert decontaminate.leaks(docs, table.limit(0)).count() == 0


def test_leaks_of_long_items_and_of_texts_with_one_id(spark):
    rng = random.Random(5)
    words = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    long, one, two = words(33_000), words(30), words(30)
    items = spark.createDataFrame([(0, " ".join(long)), (1, " ".join(one)), (1, " ".join(two))], "item_id long, text string")
    docs = [(0, long[:26_460]), (1, words(9) + one), (2, two + words(9)), (3, one + two)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    found = {(r.id, r.item_id): r.similarity for r in decontaminate.leaks(docs, items).collect()}
    assert found == {(0, 0): pytest.approx(26_456 / 32_996), (1, 1): 1.0, (2, 1): 1.0, (3, 1): 1.0}


def test_license_scan(spark):
    known = license_scan.TEMPLATES
    filler = " ".join(f"w{i}" for i in range(200))
    mit = known["MIT"].split()
    cases = {
        1: filler + " " + known["Apache-2.0"] + " " + filler,
        2: " ".join([*mit[:30], "really", *mit[31:]]),
        3: filler,
        4: None,
        5: "",
        6: " ".join(mit[: len(mit) // 3]),
        7: known["CC-BY-NC-4.0"].upper() + " " + known["GPL-3.0"],
    }
    docs = spark.createDataFrame([*cases.items(), (1, cases[1])], "doc_id long, text string").withColumn("license", F.lit("?"))
    found = license_scan.license_matches(docs, license_scan.templates(spark)).collect()
    want = set()
    for d, t in cases.items():
        have = set(plain_shingles(t or ""))
        want |= {(d, name) for name, x in known.items() if (s := set(plain_shingles(x))) and len(s & have) / len(s) >= 0.8}
    assert Counter((r.id, r.license) for r in found) == Counter(want)
    assert {(1, "Apache-2.0"), (2, "MIT"), (7, "CC-BY-NC-4.0")} <= want and not any(d == 6 for d, _ in want)
    assert license_scan.collision_probability(license_scan.CONTAINMENT / 1.5 / 1.5) > 0.999
    assert license_scan.license_matches(docs.limit(0), license_scan.templates(spark)).count() == 0
    shuffled = license_scan.license_matches(docs, license_scan.templates(spark), broadcast_rows=0).collect()
    assert sorted(shuffled) == sorted(found)


def test_license_texts_of_any_length(spark, tmp_path):
    rng = random.Random(7)
    words = [f"{rng.choice(VOCABULARY)}{rng.randrange(300)}" for _ in range(14_000)]
    long, short = words[:6000], words[6000:6300]
    (tmp_path / "Long 1.0.txt").write_text(" ".join(long))
    (tmp_path / "Short").write_text(" ".join(short))
    known = license_scan.read_templates(spark, str(tmp_path))
    assert {r.license for r in known.collect()} == {"Long 1.0", "Short"}

    def edited(text, every):
        return [f"new{i}" if i % every == every - 1 else w for i, w in enumerate(text)]

    # Every 28th word changed spoils five shingles in 28, which leaves 0.82; every 15th leaves 0.67.
    docs = [(0, words[7000:] + long + words[:50]), (1, edited(long, 28)), (2, edited(long, 15)), (3, long[:4000])]
    docs += [(10 + i, words[9000 : 9000 + 37 * i] + edited(short, 28) + words[8000 : 8000 + 11 * i]) for i in range(30)]
    docs += [(100, short * 3), (101, short[:200])]
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    want = set()
    for i, t in docs:
        have = set(plain_shingles(" ".join(t)))
        for name, x in (("Long 1.0", long), ("Short", short)):
            s = set(plain_shingles(" ".join(x)))
            if len(s & have) / len(s) >= 0.8:
                want.add((i, name))
    assert {(0, "Long 1.0"), (1, "Long 1.0"), (10, "Short"), (100, "Short")} <= want and len(want) == 33
    for broadcast_rows in (license_scan.BROADCAST_ROWS, 0):
        found = license_scan.license_matches(table, known, broadcast_rows=broadcast_rows).collect()
        got = [(r.id, r.license) for r in found]
        assert len(set(got)) == len(got) and set(got) <= want and len(got) >= 0.9 * len(want)
        assert (0, "Long 1.0") in got and (1, "Long 1.0") in got
    assert license_scan.license_matches(table, known.limit(0)).count() == 0


def test_license_length_classes():
    for n in range(1, 5000):
        c = license_scan.length_class(n)
        assert n <= c <= max(2, 1.5 * n)


# --- chat formatting -------------------------------------------------------


def test_escapes_are_reversible(spark):
    texts = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>x", r"<\|a|> <\\|b [\INST] <<SYS>> </ s> <s> [x]", "", "\\", "<", r"\<|"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", chat_format.escaped(F.col("t")).alias("e")).select("t", "e", chat_format.unescaped(F.col("e")).alias("u")).collect()
    assert all(r.t == r.u for r in rows)
    assert not any(re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", r.e) for r in rows)


def test_chat_windows(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(25):
        for turn in range(rng.randint(1, 12)):
            role = "system" if turn == 0 and conv % 3 == 0 else rng.choice(["user", "assistant", None])
            rows.append((conv, turn, role, rng.choice([None, "", prose(rng, rng.randint(1, 50)), "<|im_start|>x </s>"]), "c"))
    rows += [(99, 0, "user", prose(rng, 400), "c"), (99, 1, "assistant", "ok", "c"), (99, 1, "assistant", "ok", "c"), (None, 0, "user", "n", "c"), (None, None, "assistant", "m", "c")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    windows = chat_format.windows(turns, budget=60, history_budget=30)
    held = windows.withColumn("turns", chat_format.read_turns(F.col("formatted"))).collect()
    for w in held:
        new = w.turns[w.n_repeated :]
        cost = [len(re.findall(r"\S+", t.text)) + chat_format.TURN_TOKENS for t in new]
        assert sum(cost) <= 60 or len(new) == 1
    back = {r.conv: r for r in chat_format.read_back(windows).collect()}
    assert set(back) == {r[0] for r in rows}
    for conv, r in back.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert r.n_turns == len(own)
        assert r.turns_text == "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        assert r.loss_text == "".join(x[3] or "" for x in own if x[2] == "assistant")
    assert any(w.n_repeated for w in held) and chat_format.windows(turns.limit(0)).count() == 0


# --- learned operators -----------------------------------------------------


def test_gradients_match_differences():
    shape = gru.Shape(9, (0, 3, 6, 7, 8))
    rng = np.random.default_rng(4)
    vector = gru.initial(shape, np.ones(9)).astype(np.float64)
    vector += rng.normal(0, 0.2, len(vector))
    state = rng.normal(size=(5, gru.HIDDEN))
    inputs, targets = rng.integers(0, 9, (2, 5, 6))
    begins = (rng.random((5, 6)) < 0.2).astype(np.int64)

    def loss(values):
        """Mean negative log-likelihood, one stream and step at a time."""
        p, total = gru.unpack(values, shape), 0.0
        sigmoid = lambda x: 1 / (1 + np.exp(-x))
        for row in range(5):
            h = state[row]
            for t in range(6):
                h = h * (1 - begins[row, t])
                x = p["input"][inputs[row, t]]
                z, r = np.split(sigmoid(x[: 2 * gru.HIDDEN] + h @ p["gates"]), 2)
                n = np.tanh(x[2 * gru.HIDDEN :] + r * (h @ p["state"]))
                h = (1 - z) * n + z * h
                y = targets[row, t]
                c = max(i for i, s in enumerate(shape.class_starts) if s <= y)
                begin, end = shape.class_starts[c], shape.class_ends[c]
                by_class = np.exp(h @ p["classes"] + p["class_bias"])
                within = np.exp(p["words"][begin:end] @ h + p["word_bias"][begin:end])
                total -= np.log(by_class[c] / by_class.sum() * within[y - begin] / within.sum())
        return total / 30

    slope = np.zeros_like(vector)
    p = gru.unpack(vector, shape)
    gru.window_gradient(p, gru.unpack(slope, shape), shape, state, inputs, targets, begins)
    size = 1e-5
    for i in rng.choice(len(vector), 400, replace=False):
        step = np.zeros_like(vector)
        step[i] = size
        assert slope[i] == pytest.approx((loss(vector + step) - loss(vector - step)) / (2 * size), abs=2e-6)


def test_training_raises_likelihood_and_windows_do_not_matter():
    shape = gru.Shape(9, (0, 3, 6, 7, 8))
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 9, 70) for _ in range(3)]
    vector = gru.initial(shape, np.ones(9))
    before = gru.text_scores(gru.unpack(vector, shape), shape, texts, 0).sum()
    trained = gru.train(vector, shape, texts, 0, least_updates=60)
    assert gru.text_scores(gru.unpack(trained, shape), shape, texts, 0).sum() > before
    # Windows and neighbours do not change the likelihood of a text.
    alone = [gru.text_scores(gru.unpack(trained, shape), shape, [t], 0)[0] for t in texts]
    assert np.allclose(alone, gru.text_scores(gru.unpack(trained, shape), shape, texts, 0), rtol=1e-4)
    # One word at a time: probabilities over all symbols add up to one.
    p = gru.unpack(trained, shape)
    h = rng.normal(size=(1, gru.HIDDEN)).astype(np.float32)
    assert np.exp(gru.log_likelihood(p, shape, np.repeat(h, 9, 0), np.arange(9))).sum() == pytest.approx(1, abs=1e-4)


def test_windows_in_one_room_give_the_gradients_of_windows_apart():
    shape = gru.Shape(9, (0, 3, 6, 7, 8))
    rng = np.random.default_rng(6)
    vector = gru.initial(shape, np.ones(9))
    p, room = gru.unpack(vector, shape), gru.Room()
    for rows, steps in ((5, 6), (7, 4), (2, 9), (5, 6)):
        state = rng.normal(size=(rows, gru.HIDDEN)).astype(np.float32)
        inputs, targets = rng.integers(0, 9, (2, rows, steps), np.int32)
        begins = (rng.random((rows, steps)) < 0.2).astype(np.int32)
        shared, alone = np.zeros_like(vector), np.zeros_like(vector)
        after = gru.window_gradient(p, gru.unpack(shared, shape), shape, state, inputs, targets, begins, room)
        other = gru.window_gradient(p, gru.unpack(alone, shape), shape, state, inputs, targets, begins)
        assert np.array_equal(shared, alone) and np.array_equal(after, other)


def test_lm_small_rest_is_not_shown_again_and_again(spark, monkeypatch):
    shape = gru.Shape(9, (0, 3, 6, 7, 8))
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 9, 70).astype(np.uint16) for _ in range(40)]
    vector = gru.initial(shape, np.ones(9))
    rows = spark.createDataFrame([(t.tobytes(),) for t in texts], "symbols binary").coalesce(1)
    monkeypatch.setattr(lm_score, "TRAIN_TOKENS", 2_000)
    found = lm_score._averaged(rows, vector, shape, 0)
    assert np.allclose(found, gru.train(vector, shape, texts, 0), atol=1e-5)
    for sizes in ([], [3], [10], [9, 2], [10, 4], [10, 5], [10, 10], [4, 30, 1, 1], [3] * 17):
        made = list(lm_score.groups((np.full(n, i) for i, n in enumerate(sizes)), 10))
        assert [len(t) for g in made for t in g] == sizes
        assert all(sum(map(len, g)) >= 5 for g in made) or sum(sizes) < 5


def test_lm_base_scores(docs, empty):
    found = lm_score.language_model_scores(docs, block_bytes=4_000).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = lambda t: [*t.encode().lower().split(), b""]
    counts = Counter(w for i, t in given() if not held(i) for w in tokens(t))
    total, known = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in given():
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (known + 1))) for w in tokens(t))
        want[i, held(i), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(base, 4)] += 1
    assert Counter((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)
    assert lm_score.language_model_scores(empty).count() == 0


def test_lm_scores_match_a_plain_model(docs, monkeypatch):
    last, average = {}, lm_score._averaged

    def kept(encoded, vector, shape, start):
        last.update(vector=average(encoded, vector, shape, start), shape=shape, start=start)
        return last["vector"]

    monkeypatch.setattr(lm_score, "_averaged", kept)
    monkeypatch.setattr(lm_score, "HEAD_WORDS", 6)
    found = lm_score.language_model_scores(docs, block_bytes=4_000).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = lambda t: [*t.encode().lower().split(), b""]
    counts = Counter(w for i, t in given() if not held(i) for w in tokens(t))
    head = sorted(counts, key=lambda w: (-counts[w], w))[:6]
    tail = lambda w: zlib.crc32(w[-2:]) % 32
    in_tail, kinds = Counter(), Counter()
    for word in counts.keys() - set(head):
        in_tail[tail(word)] += counts[word]
        kinds[tail(word)] += 1
    shape = last["shape"]
    p = {name: value.astype(np.float64) for name, value in gru.unpack(last["vector"], shape).items()}
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def score(text):
        h, before, total = np.zeros(gru.HIDDEN), last["start"], 0.0
        for word in tokens(text):
            y = head.index(word) if word in head else 6 + tail(word)
            if y >= 6:
                own = counts[word] - 0.5 if counts[word] else 0.5 * kinds[y - 6] + 0.5
                total += np.log10(own / (in_tail[y - 6] + 0.5))
            x = p["input"][before]
            z, r = np.split(sigmoid(x[: 2 * gru.HIDDEN] + h @ p["gates"]), 2)
            h = (1 - z) * np.tanh(x[2 * gru.HIDDEN :] + r * (h @ p["state"])) + z * h
            c = max(i for i, s in enumerate(shape.class_starts) if s <= y)
            begin, end = shape.class_starts[c], shape.class_ends[c]
            classes = np.exp(h @ p["classes"] + p["class_bias"])
            within = np.exp(p["words"][begin:end] @ h + p["word_bias"][begin:end])
            total += np.log10(classes[c] / classes.sum() * within[y - begin] / within.sum())
            before = y
        return total

    key = lambda r: (str(r[0]), r[1])
    got = sorted(((r.id, r.score) for r in found), key=key)
    want = sorted(((i, score(t)) for i, t in given()), key=key)
    assert [str(i) for i, _ in got] == [str(i) for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], rel=1e-4, abs=1e-4)


def test_lm_shows_every_training_document_once(docs, monkeypatch):
    shown, average = Counter(), lm_score._averaged

    def counted(encoded, *args):
        shown.update(r.id for r in encoded.select("id").collect())
        return average(encoded, *args)

    monkeypatch.setattr(lm_score, "_averaged", counted)
    found = lm_score.language_model_scores(docs, block_bytes=4_000).collect()
    assert shown == Counter(r.id for r in found if not r.held_out)


def test_quality_separates_held_out_rows(spark, empty):
    rng = random.Random(8)
    rows = [(i, prose(rng, 40) if i % 2 else " ".join(f"zz{rng.randrange(9)}!!" for _ in range(40))) for i in range(400)]
    rows += [(400, None), (401, ""), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(5, 1), (6, None), (None, 1)], "doc_id long, quality int")
    found = quality.quality_scores(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    out = [r for r in found if r.held_out and r.id is not None and r.id < 400]
    assert sum(r.predicted == r.id % 2 for r in out) >= 0.95 * len(out)
    assert {r.held_out for r in found if r.id == 7} == {zlib.crc32(b"7") % 3 == 1}
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(empty, labels).count() == 0


def test_personal_data(spark, empty):
    texts = {
        1: "mail me at a.b+c@x-y.example.com or call +1 (499) 555-6503, card 4111 1111 1111 1111, ip 10.0.0.255 and 300.1.1.1.",
        2: None,
        3: "",
        4: "\U0001f600 4111-1111-1111-1112 é 1.2.3.4.5 +12 a@b " + "7" * 400,
        5: "phone: 0049 30 1234567 and write to jo at host dot com, version 1.2.3.4",
    }
    docs = spark.createDataFrame([*texts.items(), (1, texts[1]), (None, texts[1])], "doc_id long, text string").withColumn("spans", F.lit(1))
    found = personal_data.personal_data(docs).collect()
    assert len(found) == 7
    for r in found:
        text = texts[r.id or 1] or ""
        base = {tuple(s) for s in r.base}
        assert base == set(personal_data.base_spans(text)) and base <= {tuple(s) for s in r.spans}
    first = {personal_data.KINDS[k]: texts[1][a:b] for k, a, b in next(r.base for r in found if r.id == 1)}
    assert first == {"email": "a.b+c@x-y.example.com", "phone": "+1 (499) 555-6503", "card": "4111 1111 1111 1111", "ip": "10.0.0.255"}
    assert personal_data.personal_data(empty).count() == 0
    votes = np.array([[2, 2, 2, 2, 0], [1, 1, 0, 1, 1], [2, 1, 0, 2, 0]])
    posterior, share, _ = personal_data.reliabilities(votes, np.array([60.0, 30.0, 10.0]))
    assert posterior[0] > 0.9 > 0.1 > posterior[1] and 0 < share < 1


@pytest.mark.parametrize("address", ["jo.doe (at) host.com", "jo.doe [at] host.com", "jo at host.com", "jo@host dot com", "jo AT host Dot com"])
def test_loose_addresses_do_not_depend_on_the_rest(address):
    for text in (address, f"see {address} or so", f"{address} and c@d too", f"{address} , the dot"):
        start = text.index(address)
        assert (0, start, start + len(address)) in personal_data.candidates(text, personal_data.base_spans(text))


def test_candidates_match_brute_force():
    rng = random.Random(12)
    parts = ["at", "dot", "@", ".", " ", " ", "(", ")", "[", "jo", "x-y", "_", "com", "+1 499 5556503", "4111 1111 1111 1111", "10.0.0.1", "a@b.c", "AT", "Dot", "\u017f"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        base = personal_data.base_spans(text)
        want, taken = list(base), [s[1:] for s in base]
        for kind, name in enumerate(personal_data.KINDS):
            for m in personal_data.LOOSE[name].finditer(text):
                if not any(x < m.end() and m.start() < y for x, y in taken):
                    want.append((kind, *m.span()))
                    taken.append(m.span())
        assert personal_data.candidates(text, base) == want


FORMS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_spans(text):
    def passes(kind, found):
        digits = re.sub(r"\D", "", found)
        if kind == 1:
            return all(int(p) <= 255 for p in found.split("."))
        if kind == 2:
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(n - 9 * (n > 9) for n in doubled) % 10 == 0
        return kind == 0 or 8 <= len(digits) <= 15

    return [(k, *m.span()) for k, form in enumerate(FORMS) for m in re.finditer(form, text) if passes(k, m[0])]


def test_base_spans_equal_the_plain_patterns():
    """Leftmost matches without overlaps, failing ones dropped, as the patterns are written."""
    rng = random.Random(3)
    seen = Counter()
    for _ in range(20_000):
        text = "".join(rng.choice(["a", "1", ".", "@", "-", "%", " ", "+", "25", "é", "4111 1111 1111 1111", "0.0.0"]) for _ in range(rng.randrange(20)))
        want = plain_spans(text)
        assert personal_data.base_spans(text) == want
        seen.update(k for k, _, _ in want)
    assert min(seen[k] for k in range(4)) > 50


def test_long_runs_take_little_time():
    began = time.time()
    assert personal_data.base_spans("1" * 5_000 + ".1.1.1") == []
    assert personal_data.base_spans("0" * 5_000 + "9.1.1.1") == [(1, 0, 5_007)]
    for text in ("7" * 10**6, "a" * 10**6 + " x@y", "." * 10**6 + "@a.b", "a." * 500_000 + "@", "1." * 400_000, "a@" * 400_000, "x@" + "b-" * 500_000, "+1(" * 300_000, "at " * 300_000):
        personal_data.candidates(text, personal_data.base_spans(text))
    assert time.time() - began < 30


def test_the_model_adds_some_spans_and_refuses_others(spark):
    """Addresses written out in words beside mail words are added; prose of the same form is not."""
    texts = [f"contact: user{i}@host{i % 7}.com for more" for i in range(120)]
    texts += [f"please email jane{i} at host{i % 5} dot com today" for i in range(40)]
    texts += [f"they met at noon{i}. We left" for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    added = {}
    for r in personal_data.personal_data(docs).collect():
        new = [texts[r.id][s.start : s.end] for s in r.spans if s not in r.base]
        if new:
            added[r.id] = new
    assert {i for i in added} == set(range(120, 160))
    assert added[123] == ["jane3 at host3 dot com"]
