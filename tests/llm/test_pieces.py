from __future__ import annotations

import random

import public_tokenizers
import sentencepiece

from skyledger.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
EDGE = [None, "", " ", "  a  b ", "▁ x▁", "x\x00y", "a\r\n\t　é​", "</s><s><0x0A>", "ﷺ🙂🙂", "ab" * 300, "a" * 999,
        "1234567890", "the the the", "the the the"]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(seed, n):
    pick, whole = random.Random(seed), library()
    names = [whole.id_to_piece(i) for i in range(259, 32000)]
    alphabet = ["a", "e", "in", "the", " ", "  ", "\n", "é", "ß", "ﷺ", "🙂", "0", "11", "ing", "中", "ка", "▁", "́"]
    for i in range(n):
        kind = pick.randrange(3)
        if kind == 0:
            yield "".join(pick.choices(alphabet, k=pick.randrange(60)))
        elif kind == 1:  # pieces out of order give pairs that rank above those they came from
            yield "".join(pick.choices(names, k=pick.randrange(1, 12))).replace("▁", pick.choice(["", " "]))
        else:
            yield "".join(pick.choices("aeinorst", k=pick.randrange(1, 120)))


def test_ids_and_texts_are_the_librarys():
    own, whole = pieces.pieces(MODEL), library()
    rows = [x or "" for x in EDGE] + list(odd_texts(3, 12_000))
    flat, at = own.encode(rows)
    expected = whole.encode(rows, add_eos=True)
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == expected
    assert own.decode(flat, at) == whole.decode(expected)


def test_any_ids_decode_as_the_library_does():
    own, whole, pick = pieces.pieces(MODEL), library(), random.Random(8)
    lists = [[pick.choice([pick.randrange(32000), pick.randrange(259), pick.randrange(3)]) for _ in range(pick.randrange(9))]
             for _ in range(8_000)]
    at = [0]
    for x in lists:
        at.append(at[-1] + len(x))
    assert own.decode(pieces.np.array(sum(lists, []), "int32"), pieces.np.array(at)) == whole.decode(lists)


def test_long_texts_in_stretches(monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK", 997)
    own, whole = pieces.pieces(MODEL), library()
    long = [" ".join(odd_texts(5, 400)), "x" * 5_000, "ab" * 4_000 + " end", None, "short"]
    flat, at = own.encode(long)
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == whole.encode([x or "" for x in long], add_eos=True)


def test_tables(spark):
    whole = library()
    rows = [(i, x, "n", "m") for i, x in enumerate(EDGE)] + [(None, "no id", "n", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens string")
    got = pieces.encode_and_decode(docs, MODEL).collect()
    expected = sorted((i, whole.encode(x or "", add_eos=True)) for i, x, *_ in rows if i is not None)
    assert sorted((r["doc_id"], r["ids"]) for r in got if r["doc_id"] is not None) == expected
    assert len(got) == len(rows)
    assert all(r["text"] == whole.decode(r["ids"]) for r in got)
    encoded = pieces.encode(docs, MODEL)
    assert sorted((r["doc_id"], r["text"]) for r in pieces.decode(encoded, MODEL).collect() if r["doc_id"] is not None) == [
        (i, whole.decode(x)) for i, x in expected]
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["text"] for r in pieces.decode(empty, MODEL).collect()} == {""}
    assert pieces.encode_and_decode(docs.limit(0), MODEL).count() == 0
