"""The registered queries without SQL, and the pipeline, against plain rows over whole given tables."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from test_corpus import BYTES, WORDS, plain_fingerprint, plain_groups, plain_shingles, plain_spans, tokenizers

import corpus_pipeline
from turnloom.llm import license_scan, quality
from turnloom.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
KINDS = ("email", "ip", "card", "phone")


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def rows(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def items(spark):
    return {r.item_id: r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}


def plain_leaks(texts, items):
    """The largest weighted Jaccard similarity of an item and a window as long as it, from 0.8 on."""
    found = {}
    listed = {i: plain_shingles(t or "") for i, t in items.items()}
    for d, text in texts.items():
        shingles = plain_shingles(text)
        for i, item in listed.items():
            whole, n = Counter(item), len(item)
            if not n or whole.keys().isdisjoint(shingles):
                continue
            for p in range(len(shingles)):
                window = shingles[p : p + n]
                shared = sum((Counter(window) & whole).values())
                similarity = shared / (len(window) + n - shared)
                if similarity >= 0.8:
                    found[d, i] = max(similarity, found.get((d, i), 0))
    return found


def test_op1(spark, rows, items):
    found = QUERIES["op1_decontaminate"](spark, SF_DIR).collect()
    want = plain_leaks(rows, items)
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in found} == want
    assert len(found) == len(want) > 0


def test_op2(spark, rows):
    found = QUERIES["op2_lm_score"](spark, SF_DIR).collect()
    tokens = {d: [*t.encode().lower().split(), b""] for d, t in rows.items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in rows}
    counts = Counter(w for d, ws in tokens.items() if not held[d] for w in ws)
    total, known = sum(counts.values()), len(counts)
    assert Counter(r.doc_id for r in found) == Counter(list(rows))
    for r in found:
        words = tokens[r.doc_id]
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (known + 1))) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known) == (held[r.doc_id], len(words), sum(w in counts for w in words))
        assert r.train_tokens == total and r.base_score == pytest.approx(base, rel=1e-9)
        assert np.isfinite(r.score) and r.score < 0


def test_op3(spark, rows):
    library = tokenizers.Tokenizer.from_file(BYTES)
    want = set()
    for d, t in rows.items():
        ids = library.encode(t, add_special_tokens=False).ids
        want.add((d, len(ids), sha256(",".join(map(str, ids))), sha256(library.decode(ids, skip_special_tokens=False))))
    found = QUERIES["op3_bpe"](spark, SF_DIR).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert set(map(tuple, found)) == want and len(found) == len(want)


def test_op4(spark, rows):
    library = tokenizers.Tokenizer.from_file(WORDS)
    want, start = set(), 0
    for d in sorted(rows):
        ids = np.array(library.encode(rows[d], add_special_tokens=False).ids + [2], "<u4")
        want.add((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = QUERIES["op4_token_files"](spark, SF_DIR).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert set(map(tuple, found)) == want and len(found) == len(want)


def test_op7(spark, rows):
    known = {name: set(plain_shingles(t)) for name, t in license_scan.TEMPLATES.items()}
    want = set()
    for d, t in rows.items():
        have = plain_shingles(t)
        for name, template in known.items():
            # A window of a few template lengths, as wide as any that the operator compares.
            n = 3 * len(template)
            if not template or template.isdisjoint(have):
                continue
            for p in range(0, max(1, len(have))):
                if len(template.intersection(have[p : p + n])) / len(template) >= license_scan.CONTAINMENT:
                    want.add((d, name))
                    break
    found = [(r.doc_id, r.license) for r in QUERIES["op7_license_scan"](spark, SF_DIR).collect()]
    assert set(found) == want and len(found) == len(want) > 0


def test_op8(spark, rows):
    found = QUERIES["op8_quality"](spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in found) == Counter(list(rows))
    by_text = {}
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        # Nothing but the text decides (sums of floats depend on the batch).
        assert by_text.setdefault(rows[r.doc_id], r.score) == pytest.approx(r.score, abs=1e-6)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    out = [(r.score, labels[r.doc_id]) for r in found if r.held_out and labels.get(r.doc_id) is not None]
    good, bad = [s for s, y in out if y == 1], [s for s, y in out if y == 0]
    assert good and bad and np.mean([g > b for g in good for b in bad]) >= 0.9


def test_op9(spark, rows):
    ids = sorted(rows)
    prints = [plain_fingerprint(rows[d]) for d in ids]
    groups = plain_groups(prints, 4)
    want = {(d, f"{p:016x}", ids[g]) for d, p, g in zip(ids, prints, groups)}
    found = QUERIES["op9_simhash_dedup"](spark, SF_DIR).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == want and len(found) == len(want)
    assert any(d != c for d, _, c in want)


def test_op10(spark, rows):
    found = QUERIES["op10_personal_data"](spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in found) == Counter(list(rows))
    for r in found:
        base = plain_spans(rows[r.doc_id])
        listed = [f"{KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for k, _, _ in base) for i in range(4))
        assert r.base_sha256 == sha256(",".join(listed))
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans) and len(set(spans)) == len(spans)
        place = [(KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in spans)]
        assert place == sorted(place) and all(0 <= a < b <= len(rows[r.doc_id]) for _, a, b in place)


def test_pipeline(spark, items):
    """The classifier's decisions are the operator's own; all that follows is stated plainly."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    texts = {r.doc_id: r.text or "" for r in quality.keep_good(docs, labels).collect()}
    largest = {}
    for d, t in texts.items():
        largest[t] = max(d, largest.get(t, d))
    single = {d: texts[d] for d in sorted(largest.values())}
    ids = list(single)
    groups = plain_groups([plain_fingerprint(single[d]) for d in ids], 4)
    apart = {d: single[d] for i, d in enumerate(ids) if groups[i] == i}
    leaking = {d for d, _ in plain_leaks(apart, items)}
    library = tokenizers.Tokenizer.from_file(BYTES)
    want = {d: library.encode(t, add_special_tokens=False).ids for d, t in apart.items() if d not in leaking}
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: list(r.input_ids) for r in found} == want and len(found) == len(want)
    assert all(r.n_tokens == len(r.input_ids) for r in found)
    # Every stage has something to drop in the given documents.
    assert docs.count() > len(texts) > len(single) > len(apart) > len(want) > 0
