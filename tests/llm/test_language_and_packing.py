import random
import zlib

import numpy as np
import pytest

from brinkcast.llm.language_id import Encoder, identify, learn_profiles
from brinkcast.llm.packing import PieceIds, pack, pack_documents, sum_of_squares, token_pieces
from brinkcast.llm.queries import tokenizer_file

from .conftest import DOCUMENTS, sentence


def test_languages_are_told_apart_on_unseen_texts(spark):
    rnd = random.Random(3)
    alphabets = {"aa": "abcdeo", "bb": "xyzwue", "cc": "éèüßnm"}
    rows = [(lang, sentence(rnd, 30, letters)) for lang, letters in alphabets.items() for _ in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string")
    profiles = learn_profiles(df.limit(60).union(df.where("lang = 'cc'")))
    fresh = [(lang, sentence(rnd, 12, letters)) for lang, letters in alphabets.items() for _ in range(20)]
    got = identify(spark.createDataFrame(fresh, "lang string, text string"), profiles).collect()
    assert all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in got)


def test_language_edge_cases(spark):
    teach = spark.createDataFrame([("en", "the cat"), (None, "x"), ("de", None), ("fr", "le chat")], "lang string, text string")
    profiles = learn_profiles(teach)
    assert profiles.langs == ("en", "fr")
    rows = [(1, None, "a"), (2, "", "b"), (3, "123 !?", "c"), (4, "the cat " * 50_000, "d"), (4, "the cat", "d")]
    df = spark.createDataFrame(rows, "doc_id int, text string, Score string")
    got = {(r.doc_id, r.lang_pred, round(r.score, 6) > 0.8) for r in identify(df, profiles).collect()}
    assert got == {(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True)}
    assert identify(df.limit(0), profiles).count() == 0
    nothing = learn_profiles(teach.limit(0))
    assert {r.lang_pred for r in identify(df, nothing).collect()} == {"und"}


def test_bundle_is_the_sum_of_bound_trigrams():
    encoder = Encoder(64, 7)
    vectors, seen = encoder.bundles(["ab", "7"])
    a, b, gap = encoder.letter(ord("a")), encoder.letter(ord("b")), encoder.letter(0)
    want = np.roll(gap, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * gap
    assert (vectors[0] == want).all() and seen.tolist() == [True, False]


def test_long_text_in_pieces_bundles_like_a_whole():
    text = sentence(random.Random(1), 400)
    whole, _ = Encoder(64, 7).bundles([text])
    import brinkcast.llm.language_id as L

    before, L.CHARS = L.CHARS, 37
    try:
        pieces, _ = Encoder(64, 7).bundles([text])
    finally:
        L.CHARS = before
    assert (whole == pieces).all()


@pytest.mark.parametrize("text", ["a b", "ŉ ª º µ × ÷ Ÿÿ", "I'll've can't'S  \r\n\t x\x7f", "it's 12  x\n\n\ny ", "naïve – «тест» 中文", "<|endoftext|> z", "a\x1cb\x85c", "ſt K", ""])
def test_piecewise_ids_are_the_tokenizers(text):
    ids = PieceIds(tokenizer_file())
    assert ids.of([text, text])[1] == ids.encoded(text)


def test_long_texts_are_cut_where_no_piece_spans(monkeypatch):
    monkeypatch.setattr("brinkcast.llm.packing.SLICE", 7)
    monkeypatch.setattr("brinkcast.llm.packing.KEPT_PIECES", 3)
    ids = PieceIds(tokenizer_file())
    for text in ["it's  a   long\n\n text, isn't  it? " * 5, " " * 40, "x" * 40, "a b " * 30 + " ", "ab \t cd   ef  "]:
        assert ids.of([text])[0] == ids.encoded(text)


def test_pieces_cover_documents_and_sequences_have_no_gaps(spark, documents, corpus):
    ids = PieceIds(tokenizer_file())
    got = pack_documents(documents, tokenizer_file(), length=64).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert set(by_doc) == {i for i, *_ in corpus}
    for i, text, *_ in corpus:
        rows = sorted(by_doc[i], key=lambda r: r.piece)
        whole = ids.encoded(text or "") + bytes(4)
        assert b"".join(r.ids for r in rows) == whole
        assert [r.piece for r in rows] == list(range(len(rows)))
        assert all(r.length == 64 for r in rows[1:]) and rows[0].length <= 64
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(places) <= 1.05 * total / 64 + 2


def test_rule_takes_the_place_with_the_smallest_sum_of_squares():
    sizes = np.array(random.Random(2).choices(range(1, 20), k=300))
    bins, offsets = sum_of_squares(sizes, 20)
    fill = {}
    for size, b, offset in zip(sizes.tolist(), bins.tolist(), offsets.tolist()):
        def total(levels):
            gaps = [20 - u for u in levels.values() if u < 20]
            return sum(gaps.count(g) ** 2 for g in set(gaps))

        options = [total(fill | {c: u + size}) for c, u in fill.items() if u + size <= 20]
        options.append(total(fill | {"new": size}))
        assert offset == fill.get(b, 0) and offset + size <= 20
        fill[b] = offset + size
        assert total(fill) == min(options)


def test_packing_nulls_repeats_and_nothing(spark):
    rows = [(None, None, None, None, None), (1, "a b", None, None, None), (1, "a b", None, None, None)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    pieces = token_pieces(df, tokenizer_file())
    assert sorted(r.length for r in pieces.collect()) == [1, 3, 3]
    extra = pieces.selectExpr("doc_id", "length", "'x' as Offset", "crc32(ids) as c")
    packed = pack(extra).collect()
    assert {r.sequence_id for r in packed}.__len__() == 1 and sorted(r.offset for r in packed) == [0, 3, 6]
    assert {r.c for r in packed if r.doc_id is None} == {zlib.crc32(bytes(4))}
    assert pack_documents(df.limit(0), tokenizer_file()).count() == 0


def test_a_worker_forgets_what_other_operators_kept():
    from brinkcast.llm.arrow import begin, kept

    made = []

    def make():
        made.append(1)
        return len(made)

    begin("a")
    assert [kept("a", "x", make), kept("a", "x", make), kept("a", "y", make)] == [1, 1, 2]
    begin("a")
    assert kept("a", "x", make) == 1
    begin("b")
    begin("a")
    assert kept("a", "x", make) == 3
