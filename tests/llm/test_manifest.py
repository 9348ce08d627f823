"""The Merkle manifest, packing and whitening, against brute force."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterloom.llm import merkle, packing, queries, whitening
from meterloom.llm.common import read

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
EDGES = [
    (1, None, None, None, None), (1, None, None, None, None), (2, "", "", "", 0), (3, "a\nb\n", "en", "édge", 4), (None, "x\ny", "en", "edge", 3),
    (7, "a  b \n c<|endoftext|> d", "en", "lone", 1), (8, " \t\r\n  ", "en", "z", 1), (9, "word " * 30_000, "en", "z", 150_000),
    (10, "日本語 テキスト。\n\n x", "ja", "z", 1), (11, "don't  it's\r\n\r\n 12 3!! ", "en", "z", 1), (12, "1" * 9_000, "en", "z", 1),
    (13, "\xa0a \x85b\x1c c", "en", "z", 1),
]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    clash = {c: F.lit("clash") for c in ("place", "size", "node", "leaf", "key", "ids", "piece", "sort", "_tie")}
    real = read(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return real.unionByName(spark.createDataFrame(EDGES, DOCUMENT)).withColumns(clash).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


# --- manifest ----------------------------------------------------------------------------


def leaf_of(row) -> str:
    values = [None if row[k] is None else str(row[k]) for k in merkle.FIELDS]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tampered(row):
    gone = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0 and row["text"] is not None
    return {**row, "text": row["text"].replace("\n", "")} if gone else row


def climb(nodes):
    """The root, and for each leaf its steps (left, right) one level after another."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            run = nodes[place // 3 * 3 : place // 3 * 3 + 3]
            steps[k].append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        at = [place // 3 for place in at]
    return nodes[0], steps


def manifest_of(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r), leaf_of(tampered(r)), r["doc_id"]))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([x[2] for x in sorted(by_source[s])]) for s in names]
    root, above = climb([t[0] for t in trees])
    out = Counter()
    for name, (subroot, steps), over in zip(names, trees, above, strict=True):
        for (_, _, leaf, other, doc), inner in zip(sorted(by_source[name]), steps, strict=True):
            folded = other
            for left, right in inner + over:
                folded = sha(left + folded + right)
            proof = "".join(left + right for left, right in inner + over)
            out[doc, leaf, subroot, root, sha(proof), folded, folded == root] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def collected(df):
    return Counter(tuple(r) for r in df.withColumn("proof_sha256", F.sha2("proof", 256)).select(*COLUMNS).collect())


@pytest.mark.parametrize("levels", [2, 6])
def test_manifest_equals_brute_force(docs, rows, levels):
    """With two levels a block is nine leaves, so that several tables of blocks lie above each other."""
    got = merkle.manifest(docs, changed={"text": queries._tampered()}, levels=levels)
    assert collected(got) == manifest_of(rows)


def test_proofs_stand_by_themselves_and_the_untouched_verifies(docs):
    for r in merkle.manifest(docs).collect():
        assert merkle.fold(r.leaf, r.path, r.proof) == r.root == r.folded_root and r.verified


def test_manifest_of_one_row_one_source_and_none(spark, docs):
    one = docs.filter("source = 'lone'")
    (row,) = merkle.manifest(one).collect()
    assert row.leaf == row.subroot == row.root and row.path == row.proof == ""
    assert merkle.manifest(docs.limit(0)).count() == 0
    hot = spark.range(3000).select("id", F.lit(0).alias("doc_id"), F.lit("s").alias("source"), F.lit("t").alias("text"))
    same = merkle.manifest(hot, fields=("doc_id", "source", "text")).agg(F.count("*"), F.countDistinct("root"), F.countDistinct("leaf"), F.countDistinct("path"), F.bool_and("verified")).first()
    assert tuple(same) == (3000, 1, 1, 3000, True)


# --- packing -----------------------------------------------------------------------------


def test_pieces_are_the_tokenizers_ids_gapless_and_within_bounds(docs, rows):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for r in rows:
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    packed = packing.pack(docs, TOKENIZER).withColumn("crc", F.crc32("ids")).cache()
    assert Counter(tuple(r) for r in packed.select("doc_id", "piece", "start", "length", "crc").collect()) == want
    held = defaultdict(list)
    for r in packed.select("sequence_id", "offset", "length").collect():
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(k[3] * n for k, n in want.items())
    assert len(held) <= 1.02 * total / 2048 + 2
    whole = packing.sequences(packed).collect()
    assert len(whole) == len(held) and all(4 * sum(r.lengths) == len(r.ids) for r in whole)
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


def test_every_distinct_word_of_the_corpus_has_the_tokenizers_ids(spark):
    words = {w for r in read(spark, "/root/testdata/sf0.01", "documents").select("text").collect() for w in (r.text or "").split(" ")}
    listed = [" " + w for w in words]
    with open(TOKENIZER, encoding="utf-8") as file:
        encoder = packing._Encoder(file.read())
    want = Tokenizer.from_file(TOKENIZER).encode_batch(listed, add_special_tokens=False)
    assert [encoder(w) for w in listed] == [e.ids for e in want]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab'tsl \n\t\r\x0b\x1c\x85\xa0é1,日　 ɐ")), max_size=40))
def test_any_white_space_has_the_tokenizers_ids(text):
    encoder, tokenizer = _encoders()
    assert encoder(text) == tokenizer.encode(text, add_special_tokens=False).ids


def _encoders(kept=[]):  # noqa: B006
    if not kept:
        with open(TOKENIZER, encoding="utf-8") as file:
            kept += [packing._Encoder(file.read()), Tokenizer.from_file(TOKENIZER)]
    return kept


def plain_best_fit(lengths, cap, weights, by):
    bins, place = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        item = np.array([lengths[i], 1, lengths[i] ** 2], float)
        best, best_score = None, None
        for b, left in enumerate(bins):
            if (left >= item).all():
                w = np.array(weights) / np.array(cap, float) ** 2
                score = (w * (left - item) ** 2).sum() if by == "norm" else -(w * left * item).sum() / (w * left**2).sum()
                if best is None or score < best_score:
                    best, best_score = b, score
        if best is None:
            best = len(bins)
            bins.append(np.array(cap, float))
        bins[best] -= item
        place[i] = best
    return place


@pytest.mark.parametrize("by", ["norm", "dot"])
def test_best_fit_chooses_by_every_capacity(by):
    lengths = np.random.default_rng(3).integers(1, 60, 1500)
    cap = (100, 4, 4200.0)
    bins, offset = packing.best_fit(lengths, cap, (1.0, 0.3, 0.2), by)
    assert bins.tolist() == plain_best_fit(lengths.tolist(), cap, (1.0, 0.3, 0.2), by)
    for b in range(bins.max() + 1):
        mine = lengths[bins == b]
        assert mine.sum() <= 100 and len(mine) <= 4 and (mine**2).sum() <= 4200
        order = np.argsort(offset[bins == b])
        assert offset[bins == b][order].tolist() == (np.cumsum(mine[order]) - mine[order]).tolist()
    assert packing.best_fit(np.array([90, 10, 10]), (100, 4, 4200.0))[0].tolist() == [0, 1, 1]  # too dear by itself


def test_bounds_on_documents_hold_over_groups(docs):
    packed = packing.pack(docs, TOKENIZER, documents=2, group=20)
    most = packed.groupBy("sequence_id").agg(F.count("*").alias("n"), F.sum("length").alias("t")).agg(F.max("n"), F.max("t")).first()
    assert most[0] == 2 and most[1] <= 2048


# --- whitening ---------------------------------------------------------------------------


def exact(vectors):
    x = np.floor(np.asarray(vectors, np.float64) * 64).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    return x, n, s, ((n * x - s) ** 2).sum(1)


@pytest.mark.parametrize("block", [1, 64])
def test_whitening_equals_the_covariance_solved_at_once(spark, block):
    rng = np.random.default_rng(5)
    data = (rng.standard_normal((700, 12)) @ rng.standard_normal((12, 12)) * np.logspace(0, -1.5, 12)).astype(np.float32)
    odd = [(9000, None), (9001, [float("nan")] * 12), (9002, [None] + [1.0] * 11), (9003, [1.0, 2.0]), (9004, []), (9005, [float("inf")] * 12), (9006, [3e38] * 12)]
    rows = [*((k, v.tolist()) for k, v in enumerate(data)), (5, data[5].tolist()), (None, data[6].tolist())]
    frame = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("n", "id", "x", "sums", "explained")})
    got = whitening.whiten(frame, block=block, components=8).collect()
    x, n, s, deviation = exact([r[1] for r in rows])
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = centred @ vectors[:, :8] / np.sqrt(values[:8])
    assert len(got) == n and {r.n for r in got} == {n}
    assert Counter(r.deviation for r in got) == Counter(deviation.tolist())
    by_id = {r.vec_id: np.array(r.whitened) for r in got}
    found = np.array([by_id[r[0]] for r in rows])
    sign = np.sign((found * want).sum(0))
    assert np.abs(found * sign - want).max() < 1e-8
    assert np.allclose(got[0].explained, values[:8] / values.sum(), rtol=1e-10) and 0 <= got[0].identity_error < 1e-9


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    same = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(5)], schema)
    assert {(r.n, r.deviation, len(r.whitened), len(r.explained)) for r in whitening.whiten(same).collect()} == {(5, 0, 0, 0)}
    assert whitening.whiten(same.limit(0)).count() == 0
    line = spark.createDataFrame([(k, [float(k), 0.0, 1.0]) for k in range(9)], schema)  # one direction only
    (row,) = {(len(r.whitened), round(r.explained[0], 12)) for r in whitening.whiten(line).collect()}
    assert row == (1, 1.0)
    large = spark.createDataFrame([(k, [1e9 * k, 1.0]) for k in range(9)], "vec_id long, embedding array<double>")
    x = [int(64e9) * k for k in range(9)]
    assert [r.deviation for r in whitening.whiten(large).orderBy("vec_id").collect()] == [
        d if (d := (9 * a - sum(x)) ** 2) < 1 << 63 else None for a in x
    ]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(1, 30), st.integers(0, 2**32 - 1), st.integers(1, 4))
def test_rank_one_updates_keep_the_spectrum(dims, n, seed, spread):
    """Small whole numbers: equal eigenvalues, zero directions and repeated rows are the rule."""
    rows = np.random.default_rng(seed).integers(0, spread, (n, dims)).astype(float)
    halves = [whitening.Spectrum(dims), whitening.Spectrum(dims)]
    for k, r in enumerate(rows):
        halves[k % 2].add(r[None, :])
    halves[0].join(halves[1])
    want = (rows - rows.mean(0)).T @ (rows - rows.mean(0))
    got = halves[0]
    assert np.abs(got.basis @ np.diag(got.values) @ got.basis.T - want).max() < 1e-9
    assert np.abs(got.basis.T @ got.basis - np.eye(dims)).max() < 1e-10 and np.allclose(got.mean, rows.mean(0))
