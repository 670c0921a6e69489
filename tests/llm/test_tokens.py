"""Piece encoding and cross-tokenizer alignment against the libraries and brute force."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from stratum.llm.merging import ByteVocabulary, PairTable, PieceVocabulary
from stratum.llm.token_alignment import Aligner, align_tokenizers, link_index, pair_counts
from stratum.llm.pieces import decode_pieces, encode_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "a", "b", " ", "  ", "   ", "É", "é", "\n", "the", " the", "123", "'s", "<s>", "</s>", "<0x0A>", "ΑΣ", "中文", "😀", "▁",
         "\x00", "\t", "\x1c", "!!", "　", "<|endoftext|>", " " * 20]
LONG = ["", " ", "  ", "a" * 5001, "ab" * 3000, " " * 100, "中" * 3000, "x" * 2048, "xy " * 2000]


def odd_texts(n, seed):
    r = random.Random(seed)
    return LONG + ["".join(r.choice(PARTS) for _ in range(r.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return PieceVocabulary(open(MODEL, "rb").read())


def _rows(flat, counts):
    return [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])]


def test_pieces_match_the_library(library, pieces):
    texts = odd_texts(800, 1)
    ids = _rows(*pieces.encode(texts))
    assert ids == library.encode(texts)
    assert [pieces.decode([*i, 2]) for i in ids] == [library.decode([*i, 2]) for i in ids]


def test_decoding_any_ids_matches_the_library(library, pieces):
    r = random.Random(2)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(3), 259 + r.randrange(16)]) for _ in range(r.randint(0, 20))]
        assert pieces.decode(ids) == library.decode(ids)


def test_bytes_match_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = odd_texts(800, 3)
    mine = ByteVocabulary(open(path, "rb").read(), public_tokenizers.PATTERN)
    assert _rows(*mine.encode(texts)) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_pair_table_against_one_merge_at_a_time():
    """Random pairs, so that a merge may bring up lower ranks and equal ranks, in short and long sequences."""
    r = random.Random(4)
    for _ in range(150):
        pairs = {(r.randrange(12), r.randrange(12)): (r.randrange(4, 12), r.randrange(6)) for _ in range(30)}
        table = PairTable(*zip(*[(a, b, m, k) for (a, b), (m, k) in pairs.items()]), size=12)
        rows = [[r.randrange(4) for _ in range(r.randint(0, 12))] for _ in range(20)]
        expected = []
        for row in map(list, rows):
            while found := [(pairs[p][1], i) for i, p in enumerate(zip(row, row[1:])) if p in pairs]:
                i = min(found)[1]
                row[i:i + 2] = [pairs[tuple(row[i:i + 2])][0]]
            expected.append(row)
        flat, counts = table.merge(np.array([s for row in rows for s in row]), np.array([len(row) for row in rows]))
        assert _rows(flat, counts) == expected
        assert [table._merge_long(list(row)) for row in rows] == expected


def test_encode_pieces_on_odd_rows(spark, library):
    texts = [None, "", "", " a", "x " * 3000, "▁ \x00", "same", "same"]
    docs = spark.createDataFrame([(i // 2 if i < 6 else None, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = encode_pieces(docs, MODEL)
    assert got.columns == ["doc_id", "ids"]
    assert sorted(map(tuple, (r.ids for r in got.collect()))) == sorted((*library.encode(t or ""), 2) for t in texts)
    back = decode_pieces(got, MODEL).collect()
    assert sorted(r.text for r in back) == sorted(library.decode(library.encode(t or "")) for t in texts)
    assert encode_pieces(docs.limit(0), MODEL, out="digests").count() == 0


BYTES = public_tokenizers.path("byte_bpe_50k.json")


def brute_alignment(texts, library):
    """Contract rows by the libraries, one document and one link at a time; and the pairs' counts."""
    byte_library = Tokenizer.from_file(BYTES)
    byte_library.encode_special_tokens = True
    letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in letters]
    to_byte = {chr(b): b for b in letters} | {chr(256 + k): b for k, b in enumerate(rest)}
    a_bytes = lambda i: bytes(to_byte[c] for c in byte_library.id_to_token(i))
    b_bytes = lambda i: bytes([int(library.id_to_piece(i)[3:5], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode()
    made, docs, links = [], collections.Counter(), collections.Counter()
    for text in texts:
        a = byte_library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = library.encode(text) if text else []
        if not text or not b"".join(map(a_bytes, a)) == b"".join(map(b_bytes, b)) == (" " + text).encode():
            made.append(None)
            continue
        ends = [np.cumsum([len(f(i)) for i in ids]).tolist() for f, ids in ((a_bytes, a), (b_bytes, b))]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = [([i for i, e in zip(a, ends[0]) if lo < e <= hi], [i for i, e in zip(b, ends[1]) if lo < e <= hi]) for lo, hi in zip([0, *cuts], cuts)]
        own = collections.Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        docs.update(own.keys())
        links.update(own)
        made.append((len(a), len(b), groups, own))
    best = {}
    for (x, _), n in docs.items():
        best[x] = max(best.get(x, 0), n)
    rows = []
    for found in made:
        if found is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, own = found
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((n_a, n_b, len(groups), own.total(), sum(m for p, m in own.items() if docs[p] == best[p[0]]), sum(m * docs[p] for p, m in own.items()),
                     hashlib.sha256(text.encode()).hexdigest()))
    return rows, {(x, y, n, links[x, y]) for (x, y), n in docs.items()}


def test_alignment_against_brute_force(spark, library):
    texts = [None, *odd_texts(120, 5), "word word word " * 30, "same text", "same text", "same text", "ab  cd\n ef \n\n gh\x1c ij ", "中文 字 x" * 20]
    docs = spark.createDataFrame([(i if i % 7 else None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_a int").repartition(3)
    args = (BYTES, public_tokenizers.PATTERN, MODEL)
    rows, pairs = brute_alignment(texts, library)
    got = align_tokenizers(docs, *args)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert got.columns == columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(((i if i % 7 else None, *r) for i, r in enumerate(rows)), key=repr)
    assert {tuple(r) for r in pair_counts(link_index(docs, *args)).collect()} == pairs
    assert align_tokenizers(docs.limit(0), *args).count() == 0


def test_a_long_text_in_one_segment(library):
    aligner = Aligner(open(BYTES, "rb").read(), public_tokenizers.PATTERN, open(MODEL, "rb").read())
    texts = ["ab中" * 4000, "x" * 20000]
    sums, digests, pair, slot, links = aligner.block(texts)
    rows, _ = brute_alignment(texts, library)
    assert [(*s, d) for s, d in zip(sums.tolist(), digests)] == [(*r[:4], r[6]) for r in rows]
    assert [int(links[slot == k].sum()) for k in range(2)] == [r[3] for r in rows]
