"""Classifier, language identification, codecs, nearest neighbours, near copies, shards."""

from __future__ import annotations

import re
import zlib
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailyfacts.llm import (
    arrow_sequences,
    hilbert_shards,
    language_nb,
    partenum,
    piece_codec,
    posting_lists,
    quality_fm,
)

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t", "a", "one two", "x" * 30_000, "y z " * 20_000, "é ▁ 😀\x85日本 <|endoftext|>"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD)]
    return spark.createDataFrame([*rows, rows[4], (None, "no key", "en", "s", 6)], DOCS)


# Factorisation machine.


def test_pairs_by_the_identity_equal_all_pairs():
    rng = np.random.default_rng(1)
    vectors, weights = rng.normal(size=(9, 3)), rng.normal(size=9)
    machine = quality_fm.Machine(0.3, weights, vectors, 8, ())
    index, value = np.array([0, 3, 4, 8]), rng.normal(size=4)
    plain = 0.3 + sum(weights[i] * x for i, x in zip(index, value, strict=True))
    for a in range(4):
        for b in range(a + 1, 4):
            plain += vectors[index[a]] @ vectors[index[b]] * value[a] * value[b]
    assert machine.raw(index, value) == pytest.approx(plain)


def test_classifier_separates_and_handles_odd_rows(spark, odd):
    rows = [(i, ("GO!! NOW!! " if i % 5 == 0 else f"calm words follow {i} here. ") * 20, None, None, None) for i in range(400)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(300)] + [(7, None)], "doc_id long, quality int")
    machine = quality_fm.fit(docs, labels, metadata=["n_chars"])
    scores = {r.doc_id: r.score for r in quality_fm.score(docs, machine).collect()}
    assert all((scores[i] >= 0.5) == (i % 5 > 0) for i in range(300, 400))
    assert quality_fm.keep_good(docs, machine).count() == 320
    assert quality_fm.keep_good(docs, machine).columns == docs.columns
    found = quality_fm.score(odd, machine).collect()
    assert len(found) == len(ODD) + 2 and all(0 <= r.score <= 1 for r in found)
    nothing = quality_fm.fit(docs, labels.where("quality > 1"))
    assert {r.score for r in quality_fm.score(docs, nothing).collect()} == {0.5}
    assert quality_fm.score(docs.limit(0), machine).count() == 0


# Naive Bayes.


def test_languages(spark, odd):
    rows = [(i, ("the cat and the dog " if i % 2 else "le chat et la souris ") * (i % 7 + 1), "en" if i % 2 else "fr") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_nb.train(docs.where("doc_id < 100"))
    found = {r.doc_id: r for r in language_nb.predict(docs, model).collect()}
    assert all(found[i].lang_pred == rows[i][2] and 0 <= found[i].score <= 1 for i in range(200))
    strange = {r.doc_id: r.lang_pred for r in language_nb.predict(odd, model).collect()}
    assert [strange[i] for i in range(3)] == ["und"] * 3 and strange[3] in ("en", "fr")
    blank = language_nb.train(docs.limit(0))
    assert {r.lang_pred for r in language_nb.predict(docs, blank).collect()} == {"und"}


def test_scores_match_plain_naive_bayes(spark):
    texts = ["abc abd", "xyz xyy xyz", "abx", "zz"]
    docs = spark.createDataFrame(list(zip(range(4), texts, ["p", "q", "p", "q"], strict=True)), "doc_id long, text string, lang string")
    model = language_nb.train(docs)
    counts = np.zeros((2, language_nb.BUCKETS))
    for text, lang in zip(texts, [0, 1, 0, 1], strict=True):
        # Texts are counted side by side, so only n-grams inside each are compared here.
        points, _ = language_nb._code_points([text])
        for order in (1,):
            np.add.at(counts[lang], language_nb._grams(points, order, language_nb.BUCKETS), 1)
    seen = counts.sum(0) > 0
    ratio = (model.log_likelihood[seen, 0] > model.log_likelihood[seen, 1])
    assert (ratio == (counts[0] > counts[1])[seen])[(counts[0] != counts[1])[seen]].all()


def test_a_rare_language_is_predicted_as_by_plain_naive_bayes(spark):
    rng = np.random.default_rng(6)
    often = {"hot": np.full(8, 1 / 8), "rare": np.repeat([1.3, 0.7], 4) / 8}
    text = lambda lang, n: "".join(rng.choice(list("abcdefgh"), n, p=often[lang]))
    rows = [(i, text("hot", 100), "hot") for i in range(400)] + [(400, text("rare", 30_000), "rare")]
    model = language_nb.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = [text("rare", 600) for _ in range(30)] + [text("hot", 600) for _ in range(30)]
    plain = []
    for t in texts:
        points, _ = language_nb._code_points([t])
        total = model.log_prior.copy()
        for order in language_nb.ORDERS:
            total += model.log_likelihood[language_nb._grams(points, order, language_nb.BUCKETS)].sum(axis=0, dtype=float)
        plain.append(model.languages[total.argmax()])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in language_nb.predict(docs, model).collect()}
    assert plain == ["rare"] * 30 + ["hot"] * 30
    assert [found[i].lang_pred for i in range(60)] == plain
    assert all(0 <= r.score <= 1 for r in found.values())


# SentencePiece.


def test_pieces_equal_the_library_and_decode():
    from sentencepiece import SentencePieceProcessor

    library, codec = SentencePieceProcessor(model_file=PIECES), piece_codec.Codec(PIECES)
    rng = np.random.default_rng(3)
    parts = [" ", "  ", "\n", "the", "ing", "is", ".", "é", "12", "日本", "😀", "▁", "er", "on", "th", "\x1c"]
    texts = ["", " ", "▁", *["".join(rng.choice(parts, rng.integers(1, 50))) for _ in range(500)]]
    texts += ["".join(rng.choice(list("abcdething"), 5000)), "x" * 5000]
    ids = codec.encode(texts)
    assert [np.frombuffer(i, codec.type).tolist() for i in ids] == library.encode(texts)
    assert [codec.decode(i) for i in ids] == [library.decode(x) for x in library.encode(texts)]


def test_streamed_ids_do_not_depend_on_cutting_at_blanks():
    codec, whole = piece_codec.Codec(PIECES), piece_codec.Codec(PIECES)
    whole.meets = False
    text = "the things that are streamed in one go " * 40
    assert codec.encode([text]) == whole.encode([text])


def test_unigram_search_finds_the_largest_sum():
    codec = piece_codec.Codec(PIECES, bpe=False)
    rng = np.random.default_rng(5)
    for _ in range(30):
        text = "▁" + "".join(rng.choice(list("thesinga"), 40))
        best = [0.0]
        for i in range(1, len(text) + 1):
            options = [
                best[j] + codec.scores[codec.pieces[text[j:i]]]
                for j in range(max(0, i - codec.longest), i) if text[j:i] in codec.pieces
            ]
            best.append(max(options))
        found = [p for p, _ in codec.stream(text)]
        assert "".join(found) == text
        assert sum(codec.scores[codec.pieces[p]] for p in found) == pytest.approx(best[-1])


def test_encoded_rows_round_trip(spark, odd):
    encoded = piece_codec.encode(odd, PIECES)
    rows = encoded.collect()
    assert len(rows) == len(ODD) + 2 and all(r.round_trip for r in rows)
    assert {r.doc_id: r.n_ids for r in rows}[0] == 0
    texts = {r.doc_id: r.text for r in piece_codec.decode(encoded, PIECES).collect()}
    assert texts[4] == "one two" and texts[0] == ""
    assert piece_codec.encode(odd.limit(0), PIECES).count() == 0


# Arrow sequences.


def test_sequences_hold_the_library_ids(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    files = arrow_sequences.write_sequences(docs, str(tmp_path / "out"), TOKENIZER, length=64)
    rows = sorted(arrow_sequences.read_documents(files, str(tmp_path / "out")).collect())
    start = 0
    for i, text in enumerate(ODD):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        assert tuple(rows[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    first = files.orderBy("part").first()
    store, _ = arrow_sequences.open_folder(first.file)
    opened = arrow_sequences.SequenceFile(store, first.file)
    ids, mask = opened.sequence(0)
    assert len(ids) == len(mask) == 64 and opened.n_ids() == first.n_tokens
    last_ids, last_mask = opened.sequence(len(opened) - 1)
    assert mask.sum() == min(64, first.n_tokens) and not last_ids[~last_mask].any()
    empty = arrow_sequences.write_sequences(docs.limit(0), str(tmp_path / "none"), TOKENIZER)
    assert arrow_sequences.read_documents(empty, str(tmp_path / "none")).count() == 0


def test_null_and_repeated_keys_keep_their_rows(spark, odd, tmp_path):
    files = arrow_sequences.write_sequences(odd, str(tmp_path / "out"), TOKENIZER)
    assert arrow_sequences.read_documents(files, str(tmp_path / "out")).count() == len(ODD) + 2


def test_pieces_of_text_are_cut_at_token_borders():
    encoder = arrow_sequences._Encoder(TOKENIZER)
    rng = np.random.default_rng(2)
    parts = [" ", "  ", "\n", "\t", "a", "'s", "'", ".", "é", "22", "\x1c", "\x85", "<|endoftext|>", "日本", "\r\n", "!"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 30))) for _ in range(2000)]
    whole = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, encoder.type).tolist() for b in encoder(texts)] == whole


# Nearest neighbours.


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 16)) + 3 * rng.normal(size=(20, 16))[rng.integers(0, 20, 3000)]
    x[1000:1900] = x[7]
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    rows += [(5000, None), (5001, [0.0] * 16), (5002, [None] * 16), (5003, [float("nan")] + [1.0] * 15), (5004, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = posting_lists.build(vectors, centroids=40, block=200)
    found = posting_lists.search(index, vectors, vectors.vec_id % 100 == 0).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(by_query) == set(range(0, 3000, 100))
    hits = 0
    for q, got in by_query.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(3000), d)) if i != q][:10]
        assert [round(s, 12) for s, _ in got] == [round(d[i], 12) for _, i in got] and got == sorted(got)
        hits += len(set(order) & {i for _, i in got})
    assert hits >= 0.9 * 10 * len(by_query)
    few = vectors.where("vec_id < 4")
    some = posting_lists.search(posting_lists.build(few), few, few.vec_id == 0).collect()
    assert sorted(r.vec_id for r in some) == [1, 2, 3]
    assert posting_lists.search(posting_lists.build(vectors.limit(0)), vectors, vectors.vec_id == 0).count() == 0


def test_a_walk_finds_every_list_within_the_ratio():
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(150, 64))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    graph = posting_lists.neighbour_graph(centres)
    for q in rng.normal(size=(20, 64)) / 8:
        d = np.sqrt(((centres - q) ** 2).sum(1))
        within = set(np.flatnonzero(d <= 1.35 * d.min()))
        assert len(within) > posting_lists.WIDTH
        found, far, _ = posting_lists.walk(q, centres, graph, 1.35)
        assert within <= set(found) and np.allclose(far, np.sort(d[found]))


def _searched(spark, x, wanted, ids=None):
    ids = list(range(len(x))) if ids is None else ids
    rows = [(i, [float(v) for v in row]) for i, row in zip(ids, x, strict=True)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    by_query = {}
    for r in posting_lists.search(posting_lists.build(vectors), vectors, wanted).collect():
        by_query.setdefault(r.query_id, set()).add(r.vec_id)
    return by_query


def test_outliers_get_all_their_neighbours(spark):
    rng = np.random.default_rng(21)
    x = np.concatenate([rng.normal(size=(2000, 16)), 60 * rng.normal(size=(20, 16))])
    found = _searched(spark, x, F.col("vec_id") >= 2000)
    assert [len(found.get(q, ())) for q in range(2000, 2020)] == [10] * 20
    hits = sum(
        len(found[q] & set(np.argsort(((x - x[q]) ** 2).sum(1), kind="stable")[1:11].tolist())) for q in found
    )
    assert hits >= 0.9 * 200


@pytest.mark.parametrize("n", [12, 16, 24, 40])
def test_few_vectors_give_full_results(spark, n):
    found = _searched(spark, np.random.default_rng(n).normal(size=(n, 16)), F.lit(True))
    assert [len(found.get(q, ())) for q in range(n)] == [10] * n


def test_repeated_rows_of_a_key_take_one_place(spark):
    x = np.random.default_rng(4).normal(size=(60, 8))
    x[1:30] = x[0] + 0.01
    found = _searched(spark, x, F.col("vec_id") == 0, [0, *[1] * 29, *range(2, 32)])
    assert len(found[0]) == 10 and 1 in found[0]


def test_near_copies_of_long_vectors_are_told_apart(spark):
    rng = np.random.default_rng(8)
    x = 1e5 * rng.normal(size=16) + 1e-3 * rng.normal(size=(300, 16))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = posting_lists.build(vectors, centroids=1)
    found = posting_lists.search(index, vectors, vectors.vec_id < 20).collect()
    for q in range(20):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(300), d)) if i != q][:10]
        assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == order


# Near copies.


def shingles(text):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_groups(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in keys}


def test_groups_match_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = [[f"w{rng.integers(0, 4000)}" for _ in range(n)] for n in (3, 6, 9, 14, 25, 40, 70, 120, 200, 400)]
    passage = [f"common{i}" for i in range(30)]
    rows = []
    for words in base:
        for edits in [0, 0, 1, 1, 2, 3, len(words) // 40, len(words) // 30, len(words) // 25, len(words) // 20]:
            own = list(words)
            for at in rng.integers(0, len(own), edits):
                own[at] = f"e{rng.integers(0, 10**6)}"
            rows.append(" ".join(own))
    rows += [" ".join(passage + [f"u{i}x{j}" for j in range(i % 40)]) for i in range(120)]
    rows += ["", None, " \n", "Same Case here", "same case HERE", "a\x0bb\x0cc d e f"]
    numbered = list(enumerate(rows))
    docs = spark.createDataFrame([(i, t, 1) for i, t in numbered], "doc_id long, text string, component_id long")
    expected = brute_groups(numbered)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in partenum.jaccard_groups(docs).collect()}
    assert found == expected
    first = partenum.one_of_each_group(docs)
    assert first.columns == docs.columns
    assert {r.doc_id for r in first.collect()} == {i for i, (n, c) in expected.items() if not n or c == i}


def test_parity_vectors_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    for n in (1, 2, 5, 33, 300, 2000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for share in (0.0, 0.1, 0.2):
            b = np.concatenate([a[int(n * share) :], rng.integers(0, 1 << 63, int(n * share / 3)).astype(np.uint64)])
            linked = 100 * len(set(a) & set(b)) >= 75 * len(set(a) | set(b))
            assert not linked or partenum.may_link(partenum.parity(a), len(a), partenum.parity(b), len(b))


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(8)
    none = np.zeros(0, np.uint64)
    for _ in range(300):
        n = int(np.exp(rng.uniform(0, 7)))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        gone = int(rng.integers(0, len(a) // 4 + 1))
        new = rng.integers(0, 1 << 63, int(rng.integers(0, max(1, len(a) // 3 - gone + 1)))).astype(np.uint64)
        b = np.unique(np.concatenate([a[gone:], new]))
        shared = len(np.intersect1d(a, b))
        if shared and 100 * shared >= 75 * (len(a) + len(b) - shared):
            x, _ = partenum.signatures(a, none, none.astype(int))
            y, _ = partenum.signatures(b, none, none.astype(int))
            assert len(np.intersect1d(x, y))


def test_odd_rows_of_near_copies(spark, odd):
    found = partenum.jaccard_groups(odd).collect()
    assert len(found) == len(ODD) + 2
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    assert {r.component_id for r in found if r.doc_id in (0, 1, 2)} == {0, 1, 2}
    assert partenum.jaccard_groups(odd.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    found = {r.key: r.component for r in partenum.components(links).collect()}
    assert all(found[i] == 0 for i in range(61)) and found[101] == 100


# Hilbert shards.


@pytest.mark.parametrize(("n", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(n, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    index = hilbert_shards.hilbert_index(cells, bits)
    assert sorted(index) == list(range(len(cells)))
    assert all(np.abs(a - b).sum() == 1 for a, b in pairwise(cells[np.argsort(index)]))


def test_shards_are_even_and_gapless(spark, odd):
    rows = [(i, "t" * (i * 7 % 90), f"l{i % 4}", f"s{i % 9}" if i % 10 else None, i) for i in range(900)]
    docs = spark.createDataFrame(rows, DOCS)
    dealt = hilbert_shards.cut_runs(hilbert_shards.hilbert_order(docs), 8).collect()
    assert sorted(r.doc_id for r in dealt) == list(range(900))
    total = sum(r.size for r in dealt)
    for shard in range(8):
        own = [r for r in dealt if r.shard == shard]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 8) <= 100
        for r in own[:5]:
            text = rows[r.doc_id][1].encode()
            assert (r.size, r.text_crc32) == (len(text) + 8, zlib.crc32(text))
    strange = hilbert_shards.cut_runs(hilbert_shards.hilbert_order(odd)).collect()
    assert len(strange) == len(ODD) + 2
    assert hilbert_shards.cut_runs(hilbert_shards.hilbert_order(odd.limit(0))).count() == 0
