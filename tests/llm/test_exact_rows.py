"""Keys beside nulls, texts beside other texts, words across slices, special tokens, whole-text bins."""

from __future__ import annotations

import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from dailyfacts.llm import (
    arrow_sequences,
    common,
    hashing,
    hilbert_shards,
    language_nb,
    partenum,
    piece_codec,
    posting_lists,
    quality_fm,
    simhash_trie,
    source_mix,
)

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BEYOND = (1 << 53) + 1
KEYS = [BEYOND, None, -BEYOND, 4, None, BEYOND + 2]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, f"words of row {i} and more of them here", "en", "s", 9) for i, k in enumerate(KEYS)]
    return spark.createDataFrame(rows, DOCS).coalesce(1)


def op2(docs, tmp_path):
    machine = quality_fm.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality"))
    return quality_fm.score(docs, machine)


def op6(docs, tmp_path):
    files = arrow_sequences.write_sequences(docs, str(tmp_path / "s"), TOKENIZER)
    return arrow_sequences.read_documents(files, str(tmp_path / "s")).withColumnRenamed("key", "doc_id")


OPERATORS = {
    "op2": op2,
    "op3": lambda docs, _: piece_codec.encode(docs, PIECES),
    "op3 back": lambda docs, _: piece_codec.decode(piece_codec.encode(docs, PIECES), PIECES),
    "op4": lambda docs, _: partenum.jaccard_groups(docs),
    "op6": op6,
    "op8": lambda docs, _: language_nb.predict(docs, language_nb.train(docs)),
    "op9": lambda docs, _: source_mix.mix(docs),
    "op10": lambda docs, _: hilbert_shards.cut_runs(hilbert_shards.hilbert_order(docs)),
    "op13": lambda docs, _: simhash_trie.simhash_groups(docs),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_keys_beside_nulls_stay_exact(docs, tmp_path, name):
    found = [r.doc_id for r in OPERATORS[name](docs, tmp_path).collect()]
    assert sorted(found, key=str) == sorted(KEYS, key=str)


def test_vectors_without_a_key_take_no_part(spark):
    rows = [(k, [float(i), 1.0]) for i, k in enumerate(KEYS)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1)
    index = posting_lists.build(vectors)
    found = posting_lists.search(index, vectors, vectors["vec_id"] == BEYOND).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [
        (BEYOND, 1, -BEYOND, 2.0), (BEYOND, 2, 4, 3.0), (BEYOND, 3, BEYOND + 2, 5.0)
    ]


# Language identification.


def plain_posterior(model_rows, texts):
    """Scores of naive Bayes of all orders, each text by itself."""
    languages = sorted({lang for _, lang in model_rows})
    counts = np.zeros((len(languages), language_nb.BUCKETS))

    def grams(text):
        points, _ = language_nb._code_points([text])
        return np.concatenate([language_nb._grams(points, o, language_nb.BUCKETS) for o in language_nb.ORDERS])

    for text, lang in model_rows:
        np.add.at(counts[languages.index(lang)], grams(text), 1)
    smooth = counts + language_nb.SMOOTHING
    likelihood = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    prior = np.log([sum(lang == x for _, lang in model_rows) / len(model_rows) for x in languages])
    out = []
    for text in texts:
        total = likelihood[:, grams(text)].sum(axis=1, dtype=float)
        scaled = total * min(1, language_nb.EVIDENCE / (3 * (len(text) + 2))) + prior
        share = np.exp(scaled - scaled.max())
        best = (total + prior).argmax()
        out.append((languages[best], share[best] / share.sum()))
    return out


@pytest.mark.parametrize("slice_", [1 << 20, 8])
def test_a_text_is_judged_by_itself(spark, monkeypatch, slice_):
    monkeypatch.setattr(language_nb, "SLICE", slice_)
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("abyz "), rng.integers(1, 9))).strip() or "a"
    labelled = [("ab ab", "p"), ("zy", "q"), *[(word(), "pq"[int(rng.integers(2))]) for _ in range(40)]]
    schema = "doc_id long, text string, lang string"
    table = lambda rows: spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    model = language_nb.train(table(labelled).coalesce(1))
    texts = ["ay", "ab", "ay", "zz", "ay", *[word() for _ in range(60)]]
    wanted = plain_posterior(labelled, texts)
    for order in (range(len(texts)), rng.permutation(len(texts))):
        order = [int(i) for i in order]
        df = spark.createDataFrame([(i, texts[i], None) for i in order], schema).coalesce(1)
        found = {r.doc_id: r for r in language_nb.predict(df, model).collect()}
        assert [found[i].lang_pred for i in range(len(texts))] == [w[0] for w in wanted]
        assert [found[i].score for i in range(len(texts))] == pytest.approx([w[1] for w in wanted], abs=1e-12)


# Hashes of words.


@pytest.mark.parametrize("slice_", [1, 2, 3, 7, 64])
def test_words_across_slices_have_the_same_hashes(monkeypatch, slice_):
    rng = np.random.default_rng(9)
    parts = list("abAB") + [" ", "\n", "\x0b", "é", "日", "x" * 20, "  "]
    texts = [None, "", " ", *["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(60)]]
    whole = hashing.word_hashes(texts)
    monkeypatch.setattr(hashing, "SLICE", slice_)
    for a, b in zip(whole, hashing.word_hashes(texts), strict=True):
        assert (a == b).all()
    hashes, begins, sizes = whole
    names: dict[int, str] = {}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert [len(w.encode()) for w in words] == sizes[begins[i] : begins[i + 1]].tolist()
        for word, h in zip(words, hashes[begins[i] : begins[i + 1]].tolist(), strict=True):
            lower = "".join(c.lower() if c.isascii() else c for c in word)
            assert names.setdefault(h, lower) == lower
    assert len(set(names.values())) == len(names)


def test_caches_go_when_a_worker_turns_to_something_else():
    common.process_cache("one")["a"] = 1
    assert common.process_cache("one") == {"a": 1}
    common.process_cache("two")["b"] = 2
    assert common.process_cache("one") == {}
    common.process_cache(None)
    assert common.process_cache("two") == {}
    numbers = dict.fromkeys(range(10))
    common.forget_oldest(numbers, 10)
    assert len(numbers) == 10
    common.forget_oldest(numbers, 9)
    assert list(numbers) == [6, 7, 8, 9]


def test_tables_of_a_scope_go_with_it(spark, docs):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    with common.scratch_scope(spark):
        passing = common.kept(docs, "passing")
        lasting = common.kept(passing.where("doc_id is not null"), "lasting", lasting=True)
    assert [name.split("-")[1] for name in set(os.listdir(folder)) - before] == ["lasting"]
    assert lasting.count() == 4 and common.kept(docs, "outside").count() == 6
    left = partenum.one_of_each_group(docs)
    made = {name.split("-", 1)[1].rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert made == {"lasting", "outside", "jaccard-groups", "jaccard-repeated"}
    assert left.count() == 6


# Pieces.


def test_the_window_commits_inside_long_words():
    from sentencepiece import SentencePieceProcessor

    library, codec = SentencePieceProcessor(model_file=PIECES), piece_codec.Codec(PIECES)
    rng = np.random.default_rng(10)
    words = ["▁" + "".join(rng.choice(list("ethingsaou日"), 700)) for _ in range(6)]
    for word in words:
        windows = list(codec._windows(word, ([0], [-1], [0.0])))
        assert len(windows) > 3
        assert all(a[0][-1] == b[0][0] for a, b in zip(windows, windows[1:], strict=False))
    normal = [library.normalize(w) for w in words]
    assert [np.frombuffer(i, codec.type).tolist() for i in codec.encode_normal(normal)] == library.encode(words)


def test_few_remembered_words_and_small_slices_give_the_same_ids(spark):
    texts = [f"Zeile {i} of été{i % 7} and words{i}" for i in range(60)] + [None, "", "Zeile 3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    small = piece_codec.encode(docs, PIECES, remembered=10, slice_bytes=100)
    assert sorted(small.collect()) == sorted(piece_codec.encode(docs, PIECES).collect())
    codec = piece_codec.Codec(PIECES, remembered=10)
    for part in piece_codec._slices(pa.array(texts), 100):
        codec.encode(part[1])
        assert len(codec.known) <= 10


def test_words_share_the_places_of_their_beginnings():
    codec, alone = piece_codec.Codec(PIECES), piece_codec.Codec(PIECES)
    rng = np.random.default_rng(11)
    words = list({"▁" + "".join(rng.choice(list("ethi😀"), rng.integers(0, 90))) for _ in range(300)} | {""})
    assert dict(codec.word_ids(words)) == {w: next(alone.word_ids([w]))[1] for w in words}


# Sequences.


def test_special_tokens_are_what_the_library_makes_of_them(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(TOKENIZER)
    texts = ["hello <|endoftext|> world", "a  <|endoftext|>b", "<|endoftext|>", "plain  text", "<|endof text|>"]
    assert 50256 in library.encode(texts[0], add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    files = arrow_sequences.write_sequences(docs, str(tmp_path / "s"), TOKENIZER, length=8)
    for row in arrow_sequences.read_documents(files, str(tmp_path / "s")).collect():
        ids = [*library.encode(texts[row.key], add_special_tokens=False).ids, 0]
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and row.n_tokens == len(ids)


def test_sequences_are_views_of_the_file(spark, tmp_path):
    docs = spark.createDataFrame([(1, "some words " * 40)], "doc_id long, text string")
    file = arrow_sequences.write_sequences(docs, str(tmp_path / "s"), TOKENIZER, length=16).first().file
    opened = arrow_sequences.SequenceFile(*arrow_sequences.open_folder(file))
    ids, mask = opened.sequence(len(opened) - 1)
    assert mask.dtype == bool and len(mask) == 16 and not ids.flags.owndata
    assert arrow_sequences.qualified_folder(spark, str(tmp_path)) == f"file:{tmp_path}"


def test_only_known_tokenizer_files_are_cut_at_blanks():
    described = {"model": {"type": "BPE"}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False}}
    assert arrow_sequences.cuts_before_blanks(described)
    for change in (
        {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"pre_tokenizer": None},
        {"pre_tokenizer": {"type": "ByteLevel", "use_regex": False}}, {"model": {"type": "Unigram"}},
        {"added_tokens": [{"content": "<x>", "lstrip": True}]},
    ):
        assert not arrow_sequences.cuts_before_blanks({**described, **change})


def test_pieces_end_at_line_feeds_and_hold_the_library_ids():
    encoder = arrow_sequences._Encoder(TOKENIZER)
    spaces = ["", " ", "  ", "\n", "\n\n", " \n", "\n ", " \n \n", "\t", "\n\t", "\t\n", "　", "\x1c", "\x85\n", "\r\n"]
    words = ["it's", "42", "é.", "word", "<|endoftext|>"]
    rng = random.Random(6)
    texts = ["".join(rng.choice(spaces) + rng.choice(words[:4]) for _ in range(9)) + rng.choice(spaces) for _ in range(3000)]
    texts += [*spaces, "a\nb c\nd", *[a + w + b for a in spaces for w in words for b in spaces]]
    for _ in range(2):  # The second time all pieces are known.
        for start in range(0, len(texts), 500):
            part = texts[start : start + 500]
            whole = encoder.tokenizer.encode_batch(part, add_special_tokens=False)
            assert [np.frombuffer(ids, encoder.type).tolist() for ids in encoder(part)] == [e.ids for e in whole]
    fresh = arrow_sequences._Encoder(TOKENIZER)
    fresh(["one end.\nbegin", "other end.\nbegin"])
    assert set(fresh.known) == {"end.", "\nbegin"}


def test_letters_and_marks_go_straight_to_the_model_with_the_library_ids():
    encoder = arrow_sequences._Encoder(TOKENIZER)
    rng = random.Random(7)
    letters = ["the", "Été", "ñ", "garçon", "Straße", "×", "ł", "x", "zählen", "K"]
    marks = ["", ".", "...", "'s", "'", "$$$", "_", "!?", "#%&", "-", "^`~", "7", "\x7f", "€", "(a)", "@b.c"]
    texts = [
        "".join(rng.choice([" ", " ", "\n", ""]) + rng.choice(letters) * rng.randint(1, 3) + rng.choice(marks) for _ in range(8))
        for _ in range(3000)
    ]
    whole = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(ids, encoder.type).tolist() for ids in encoder(texts)] == [e.ids for e in whole]
    plain = arrow_sequences._Encoder(TOKENIZER)
    plain.known.ids = {"": b"", ".": b"\x0d\x00"}.get  # Words themselves do not come here.
    assert len(plain([" été le mot."])[0]) > 2 and set(plain.known) == {"été", "le", "mot."}


# Shards.


def plain_cells(values, bins):
    """Bin of each value: how many cuts are below it; a cut is a value at which a bin fills."""
    known = sorted(v for v in values if v is not None)
    n_null, cuts = len(values) - len(known), []
    for i, v in enumerate(known):
        if i + 1 < len(known) and known[i + 1] == v:
            continue
        before, upto = n_null + known.index(v), n_null + i + 1
        if before * bins // len(values) < upto * bins // len(values) and upto < len(values):
            cuts.append(v)
    return [0 if v is None else sum(c < v for c in cuts) for v in values]


def test_texts_are_binned_whole(spark):
    rng = np.random.default_rng(12)
    names = [None, "common_crawl_a", "common_crawl_b", "common_crawl_c", "common_crawl_d", "é" * 9, "日本", "", "Z" * 50]
    share = np.array([1, 9, 2, 2, 2, 1, 1, 1, 1]) / 20
    rows = [(i, None, None, names[k], None) for i, k in enumerate(rng.choice(len(names), 400, p=share))]
    docs = spark.createDataFrame(rows, DOCS)
    found = hilbert_shards.hilbert_order(docs, dimensions=["source"], bits=5).collect()
    cells = plain_cells([r[3] for r in rows], 32)
    assert len(set(cells)) >= 8
    index = hilbert_shards.hilbert_index(np.array(cells)[:, None], 5)
    assert {r.doc_id: r.place for r in found} == dict(enumerate(index.tolist()))


def test_shards_follow_the_curve(spark):
    """The whole order by brute force: places from bins, then text hash and key, cut at equal bytes."""
    rng = np.random.default_rng(13)
    rows = [
        (int(i), "t" * int(rng.integers(0, 300)), ["de", "en", None][i % 3], f"source_{int(rng.integers(40)):03d}", int(i))
        for i in range(500)
    ]
    dims = ["source", "lang"]
    docs = spark.createDataFrame(rows, DOCS)
    cells = np.array([plain_cells([r[3] for r in rows], 32), plain_cells([r[2] for r in rows], 32)]).T
    place = hilbert_shards.hilbert_index(cells, 5).tolist()
    order = sorted(range(500), key=lambda i: (place[i], zlib.crc32(rows[i][1].encode()), i))
    total, upto, slots, wanted = sum(len(r[1]) + 8 for r in rows), 0, {}, {}
    for i in order:
        size = len(rows[i][1]) + 8
        shard = min(23, int((upto + size / 2) * 24 // total))
        wanted[i] = (shard, slots.get(shard, 0))
        slots[shard] = slots.get(shard, 0) + 1
        upto += size
    dealt = hilbert_shards.cut_runs(hilbert_shards.hilbert_order(docs, dimensions=dims)).collect()
    assert {r.doc_id: (r.shard, r.slot) for r in dealt} == wanted


def test_hash_in_sql_equals_the_library():
    import duckdb
    import xxhash

    from dailyfacts.llm.xxhash_sql import xxhash64

    words = ["", "a", "abcd", "1234567", "12345678", "x" * 31, "x" * 32, "x" * 33, "é日本 über straße", "w" * 100 + "é😀"]
    con = duckdb.connect()
    con.execute("create table words (s varchar)")
    con.executemany("insert into words values (?)", [[w] for w in words])
    for seed in (0, 42):
        found = dict(con.sql(xxhash64("words", seed)).fetchall())
        assert {w: int(h) for w, h in found.items()} == {w: xxhash.xxh64_intdigest(w.encode(), seed) for w in words}
