"""Vector codes, periodic runs and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from dailyfacts.llm import periodic_runs, queries, simhash_trie, slice_codes

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BEYOND = (1 << 53) + 1
VECTORS = "vec_id long, embedding array<float>, label int, code string, key long"
DOCS = "doc_id long, text string, key string, row string, print int, body string"
ODD = [
    None, "", " \n\t", "a", "one two", "x" * 30_000, "y z " * 20_000, "é ▁ 😀\x85日本 A a",
    "same " * 40, "Same " * 40, "s " * 23, "s " * 24, "p q r " * 8 + "tail", "lead " + "p q r " * 9,
]


def odd_docs(spark):
    rows = [(i, t, "k", "r", 1, "b") for i, t in enumerate(ODD)]
    return spark.createDataFrame(
        [*rows, rows[8], (None, "one two", None, None, None, None), (None, None, None, None, None, None),
         (BEYOND, "a b c " * 30, None, None, None, None), (4, "a b c " * 30, None, None, None, None)], DOCS,
    )


# Vector codes.


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """``{place: (code, error)}`` and the digest, by distances to all entries."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    matrix = np.floor(np.array([r[1] for r in rows], dtype=float) * 1024).astype(np.int64)
    width = matrix.shape[1] // parts
    books, codes, errors = [], [], 0
    for p in range(parts):
        part = matrix[:, p * width : (p + 1) * width]
        book = part[:entries].copy()
        for _ in range(rounds):
            near = ((part[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
            for e in np.unique(near):
                book[e] = part[near == e].sum(axis=0) // (near == e).sum()
        distance = ((part[:, None] - book[None]) ** 2).sum(axis=2)
        codes.append(distance.argmin(axis=1))
        errors = errors + distance.min(axis=1)
        books += [str(x) for x in book.ravel().tolist()]
    text = ["".join(f"{c[i]:02x}" for c in codes) for i in range(len(rows))]
    return list(zip([r[0] for r in rows], text, errors.tolist(), strict=True)), hashlib.sha256(
        ",".join(books).encode()).hexdigest()


def test_nearest_entries_by_slices_equal_all_distances():
    rng = np.random.default_rng(3)
    for n, dims, spread in ((1, 3, 5), (2, 1, 3), (70, 4, 4), (256, 16, 400), (256, 2, 1 << 22)):
        book = rng.integers(-spread, spread + 1, (n, dims))
        asked = np.concatenate([book, rng.integers(-2 * spread, 2 * spread + 1, (3000, dims))])
        distance = ((asked[:, None] - book[None]) ** 2).sum(axis=2)
        index, found = slice_codes.Slices(book).nearest(asked)
        assert (found == distance.min(axis=1)).all() and (index == distance.argmin(axis=1)).all()


def test_codes_of_odd_rows_and_ties(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(np.float32(x)) for x in v], int(i) % 3 or None) for i, v in enumerate(rng.normal(size=(400, 8)))]
    rows += [rows[5], (7, rows[9][1], 1), (BEYOND, rows[11][1], 2), (None, rows[12][1], None)]
    bad = [(900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] * 8, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + bad + [(904, [1.0] * 7, 1)]], VECTORS)
    found = slice_codes.compress(df).collect()
    wanted, digest = plain_codes([r[:2] for r in rows])
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.vec_id, r.code, r.error) for r in found], key=order) == sorted(wanted, key=order)
    assert {r.codebooks_sha256 for r in found} == {digest}
    label = {r[0]: r[2] for r in rows if r[0] not in (5, 7)}
    assert sum(r.error for r in found) == sum({label.get(r.vec_id, 0): r.label_error for r in found if r.vec_id in label}.values())


def test_codes_of_empty_tables_and_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert slice_codes.compress(empty).collect() == []
    none = spark.createDataFrame([(1, [], 1, "", 1), (2, [], 1, "", 1)], VECTORS)
    assert [(r.code, r.error) for r in slice_codes.compress(none).collect()] == [("00000000", 0)] * 2
    large = spark.createDataFrame([(1, [1e30], 1, "", 1)], VECTORS)
    with pytest.raises(ValueError, match="beyond"):
        slice_codes.compress(large)


def test_decoded_vectors_are_as_far_as_the_error_says(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    books = slice_codes.fit(vectors)
    coded = slice_codes.encode(vectors, books)
    both = coded.join(slice_codes.decode(coded, books), "key").join(vectors.withColumnRenamed("vec_id", "key"), "key")
    for r in both.collect():
        whole = np.floor(1024 * np.array(r.embedding, dtype=float)) - 1024 * np.array(r.vector)
        assert (whole**2).sum() == r.error


# Periodic runs.


def plain_runs(words):
    found = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(24, 3 * q):
                part = words[i : j + q]
                if not any(part[d:] == part[:-d] for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted((s, length, q) for s, length, q in found)


def plain_digest(doc_id, text, plant=True):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def by_key(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r[0] or 0, r[-1]))


def random_words(rng, n, letters):
    words = []
    while len(words) < n:
        if rng.random() < 0.6:
            root = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 50]))]
            words += (root * 9)[: rng.randrange(2 * len(root), 8 * len(root))]
        else:
            words += [rng.choice(letters) for _ in range(rng.randrange(1, 30))]
    return words[:n]


def test_runs_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [
        (i, " ".join(random_words(rng, rng.choice([5, 24, 25, 40, 100, 400]), "abcdefghij"[: rng.choice([1, 2, 3, 10])])))
        for i in range(300)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = periodic_runs.run_digests(docs).select(*COLUMNS).collect()
    assert by_key(found) == by_key(plain_digest(i, t, plant=False) for i, t in rows)
    assert sum(r.n_runs for r in found) > 100


def test_runs_of_odd_rows(spark):
    docs = odd_docs(spark)
    small = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 20_000]
    found = by_key(periodic_runs.run_digests(docs).select(*COLUMNS).collect())
    assert len(found) == docs.count()
    keys = {(k, plain_digest(k, t, plant=False)[-1]) for k, t in small}
    assert [r for r in found if (r[0], r[-1]) in keys] == by_key(plain_digest(k, t, plant=False) for k, t in small)
    assert next(r for r in found if r[0] == 6)[1:6] == (1, 0, 40_000, 2, 20_000_000)
    empty = periodic_runs.run_digests(spark.createDataFrame([], DOCS))
    assert empty.columns == COLUMNS and empty.collect() == []


def test_a_long_run_is_stitched_from_tiles_of_many_tasks(spark):
    root = [f"w{i}" for i in range(700)]
    text = " ".join(["lead", *(root * 8)[:5000], "tail"])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    plain, runs = periodic_runs.find_runs(docs)
    assert [(r.start, r.length, r.period) for r in runs.collect()] == [(1, 5000, 700)]
    done, _ = periodic_runs.collapsed_texts(plain, runs)
    assert bytes(done.first().collapsed).decode() == " ".join(["lead", *root, "tail"])


def test_registered_runs_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    short = [(r.doc_id, r.text) for r in docs if len(WORD.findall(r.text or "")) < 800]
    found = queries.QUERIES["op12_periodic_runs"](spark, SF_DIR)
    assert found.count() == len(docs)
    ids = {k for k, _ in short}
    assert by_key(r for r in found.select(*COLUMNS).collect() if r.doc_id in ids) == by_key(plain_digest(*r) for r in short)


# Fingerprints.


def plain_print(text):
    words = [w for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """Component of every ``(key, print)``, in order; null keys name no component."""
    prints = sorted({p for _, p in rows})
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= 3:
                parent[root(p)] = root(q)
    least = defaultdict(list)
    for key, p in rows:
        if key is not None:
            least[root(p)].append(key)
    return [min(least[root(p)], default=None) for _, p in rows]


def check_prints(df, texts):
    rows = [(k, plain_print(t)) for k, t in texts]
    wanted = [(k, f"{p:016x}", c) for (k, p), c in zip(rows, plain_components(rows), strict=True)]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, df.collect()), key=order) == sorted(wanted, key=order)


def test_registered_fingerprints_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    check_prints(queries.QUERIES["op13_simhash_trie"](spark, SF_DIR), [(r.doc_id, r.text) for r in docs.collect()])


def test_fingerprints_of_odd_rows(spark):
    docs = odd_docs(spark)
    check_prints(simhash_trie.simhash_groups(docs, node=2), [(r.doc_id, r.text) for r in docs.collect()])
    assert simhash_trie.simhash_groups(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("node", [3, 40, 1 << 14])
def test_trie_links_connect_what_all_pairs_connect(spark, node):
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    flips = [rng.choice(64, rng.integers(0, 6), replace=False) for _ in range(500)]
    near = [int(base[i % 60]) ^ sum(1 << int(b) for b in f) for i, f in enumerate(flips)]
    # A dense group: all fingerprints within two bits of one.
    near += [(1 << 63 | 12345) ^ (1 << a) ^ (1 << b) for a in range(0, 24) for b in range(a)]
    prints = sorted(set(near))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash_trie.links(spark.createDataFrame([(p,) for p in signed], "print long"), node).collect()
    assert all((((r.a ^ r.b) & ((1 << 64) - 1))).bit_count() <= 3 for r in found)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for r in found:
        a, b = root(r.a & ((1 << 64) - 1)), root(r.b & ((1 << 64) - 1))
        parent[max(a, b)] = min(a, b)
    groups = plain_components(list(zip(prints, prints, strict=True)))
    assert [root(p) for p in prints] == [root(g) for g in groups]
    assert len({root(p) for p in prints}) == len(set(groups))


def test_long_texts_are_hashed_in_slices(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000))
    whole = simhash_trie.fingerprint(text)
    monkeypatch.setattr(simhash_trie, "SLICE", 64)
    assert simhash_trie.fingerprint(text) == whole == plain_print(text)
