from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from terrane.llm.byte_bpe import ByteBpe
from terrane.llm.packing import CapacityTree, best_fit_lots, pack
from terrane.llm.sentencepieces import Encoder, MergeVocabulary, encode_texts, sentence_pieces
from terrane.llm.token_files import read_token_files, token_files, write_token_files

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    " ", "  ", "\n", "\n\n", ".", ",", "a", "B", "é", "1", "22", "'s", "'", "%", "\t", "\u3000",
    "\xa0", "<|endoftext|>", "<s>", "!", "😀", "_", "word", "the", "ing", "\r\n", "\u0301", ";",
    "\x85", "²", "▁", "▁▁", "\x00", "\ufeff", "<0x0A>", "http://", "    ", "abc" * 30,
]


def odd_strings(count: int) -> list[str]:
    chosen = random.Random(3)
    return ["".join(chosen.choices(BITS, k=chosen.randint(0, 14))) for _ in range(count)]


def byte_ids(texts):
    encoder = Tokenizer.from_file(BYTES)
    return [np.array(encoder.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for t in texts]


def test_byte_ids_equal_the_library():
    own, texts = ByteBpe(BYTES, most=500), odd_strings(5000)
    for start in range(0, len(texts), 250):
        batch = texts[start : start + 250]
        assert own.batch(batch) == [own.whole(text) for text in batch]


def test_words_are_kept_apart_from_marks_and_lines():
    """Words that meet others at marks and line ends leave no memory of each combination."""
    own, words = ByteBpe(BYTES), [f"w{'abcdefghij'[k % 10]}x{'klmnopqrst'[k // 10]}" for k in range(100)]
    texts = [f"a {one}{mark}{other}" for one in words for other in words[:20] for mark in ("\n", "###", "$%")]
    for text in ("a b#c", "it's#'s", "x\ny\n\nz", "#\n#", "a\n b", "p*\nq's"):
        assert own.batch([text]) == [own.whole(text)]
    calls, whole = [], own.whole
    own.whole = lambda text: calls.append(text) or whole(text)
    assert own.batch(texts) == [whole(text) for text in texts]
    assert len(calls) <= 10


@pytest.mark.parametrize("short", [0, 32])
def test_piece_ids_equal_the_library(monkeypatch, short):
    monkeypatch.setattr("terrane.llm.sentencepieces.SHORT", short)
    vocabulary = MergeVocabulary(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder, texts = Encoder(vocabulary, most=500), odd_strings(4000)
    for start in range(0, len(texts), 250):
        batch = texts[start : start + 250]
        told = library.encode(batch, num_threads=1)
        assert encode_texts(encoder, batch) == told
        assert [vocabulary.decode(ids) for ids in told] == library.decode(told)


def spaceless(count: int) -> list[str]:
    """Texts without spaces: of ideographs, of letters, of emoji that need byte pieces."""
    chosen = random.Random(5)
    letters = ["".join(map(chr, range(0x4E00, 0x4E00 + 900))), "abcdefghij", "😀🜁𐍈é"]
    return ["".join(chosen.choices(letters[k % 3], k=5_000)) for k in range(count)]


def test_memories_stay_small_on_texts_without_spaces():
    vocabulary, texts = MergeVocabulary(PIECES), spaceless(60)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    pieces, parts = Encoder(vocabulary, most_bytes=1 << 20), ByteBpe(BYTES, most_bytes=1 << 20)
    for start in range(0, len(texts), 10):
        batch = texts[start : start + 10]
        assert encode_texts(pieces, batch) == library.encode(batch)
        assert parts.batch(batch) == [parts.whole(text) for text in batch]
        assert max(map(len, [*pieces.pieces, *pieces.parts, *parts, "-"])) <= 128
    many = [f"w{k} x{k}" for k in range(30_000)]
    for start in range(0, len(many), 1_000):
        encode_texts(pieces, many[start : start + 1_000])
        parts.batch(many[start : start + 1_000])
        assert pieces.held <= 3 << 20 and parts.held <= 3 << 20
    assert len(pieces.pieces) < 10_000 and len(parts) < 30_000


def test_what_the_library_does_otherwise_is_found(monkeypatch):
    vocabulary = MergeVocabulary(PIECES)
    vocabulary.piece_ids = vocabulary.piece_ids + 1
    with pytest.raises(ValueError, match="otherwise"):
        encode_texts(Encoder(vocabulary), ["some words"])
    vocabulary = MergeVocabulary(PIECES)
    monkeypatch.setattr(vocabulary.library, "decode", lambda ids: ["other"] * len(ids))
    with pytest.raises(ValueError, match="otherwise"):
        encode_texts(Encoder(vocabulary), ["some words"])


def test_sentence_pieces(spark, odd, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def expected(row):
        ids = library.encode(row.text or "")
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        return row.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))

    texts = [(k, text) for k, text in enumerate(odd_strings(3000) + spaceless(6))]
    more = odd.select("doc_id", "text").unionByName(spark.createDataFrame(texts, "doc_id long, text string"))
    found = sentence_pieces(more, PIECES).drop("n_unknown").collect()
    assert Counter(map(tuple, found)) == Counter(map(expected, more.collect()))
    assert sentence_pieces(nothing, PIECES).count() == 0


def test_token_files(spark, odd, nothing, documents, tmp_path):
    both = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    files = write_token_files(both, BYTES, str(tmp_path / "files"))
    rows = sorted(read_token_files(spark, files).collect(), key=lambda r: r.start)
    texts = {}
    for row in both.collect():
        texts.setdefault(row.doc_id, []).append(row.text)
    expected = Counter()
    for key, of_key in texts.items():
        expected.update((key, len(ids), zlib.crc32(ids)) for ids in byte_ids(of_key))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    at = 0
    for row in rows:
        assert row.start == at
        at += row.n_tokens
    keys = [row.doc_id if row.doc_id is not None else -1 for row in rows]
    assert keys == sorted(keys)
    assert token_files(nothing, BYTES).count() == 0


def test_token_ids_that_need_more_bits(odd):
    wide = token_files(odd, BYTES).count()
    assert wide == odd.count()


def plain_best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        best = min((left for left in bins if left >= length), default=None)
        if best is None:
            bins.append(capacity - length)
        else:
            bins[bins.index(best)] -= length
    return sorted(bins)


def test_lots_equal_plain_best_fit():
    chosen = random.Random(1)
    for _ in range(200):
        capacity = chosen.choice([1, 10, 17, 50])
        lengths = [chosen.randint(1, capacity) for _ in range(chosen.randint(0, 120))]
        used = Counter()
        for lot in best_fit_lots(Counter(lengths), capacity):
            for k in range(lot.count):
                used[lot.sequence + k // lot.each] += lot.length
        assert sorted(capacity - n for n in used.values()) == plain_best_fit(lengths, capacity)


def test_tree_finds_the_tightest():
    tree, held, chosen = CapacityTree(2048), Counter(), random.Random(2)
    for _ in range(500):
        capacity = chosen.randint(0, 2048)
        tree.add(capacity, 1)
        held[capacity] += 1
        least = chosen.randint(0, 2048)
        assert tree.tightest(least) == min((c for c in held if c >= least), default=None)


def test_pack(odd, nothing, documents):
    both = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    rows = pack(both, BYTES, 256).collect()
    expected, lengths = Counter(), []
    for row, ids in zip(both.collect(), byte_ids([r.text for r in both.collect()])):
        first = len(ids) % 256 or min(256, len(ids))
        bounds = [0, *range(first, len(ids) + 1, 256)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            expected[(row.doc_id, piece, a, b - a, zlib.crc32(ids[a:b]))] += 1
            lengths.append(b - a)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    fill = {}
    for row in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert row.offset == fill.get(row.sequence_id, 0)
        fill[row.sequence_id] = row.offset + row.length
    assert sorted(256 - n for n in fill.values()) == plain_best_fit(lengths, 256)
    assert pack(nothing, BYTES).count() == 0
