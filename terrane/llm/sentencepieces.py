"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from terrane.llm.common import (
    batch_rows,
    documents_of,
    kept_by_worker,
    map_arrow,
    no_cycles,
    texts_of,
)

SPACE = "▁"  # what a space is written as inside pieces
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")
BATCH_BYTES = 4 << 20
SHORT = 32
ROWS = 50_000


class MergeVocabulary:
    """The pieces of a model, and what encoding and decoding need of them.

    Right for models as they are commonly trained: type BPE, identity normalization with a
    space put before the text, byte fallback. `check_against` finds any other.
    """

    def __init__(self, model_path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = range(self.library.get_piece_size())
        pieces = [self.library.id_to_piece(i) for i in ids]
        special = [self.library.is_control(i) or self.library.is_unknown(i) for i in ids]
        byte = [self.library.is_byte(i) for i in ids]
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i] and not byte[i]}
        scores = {p: self.library.get_score(i) for p, i in self.ids.items()}
        order = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {p: order[score] for p, score in scores.items()}
        self.never = len(order)  # no piece has this rank; the best score has 0
        self.byte_ids = {}
        self.surfaces: list[bytes] = []
        for i, piece in enumerate(pieces):
            if byte[i]:
                value = int(_BYTE_PIECE.match(piece)[1], 16)
                self.byte_ids[value] = i
                self.surfaces.append(bytes([value]))
            else:
                self.surfaces.append(b"" if special[i] else piece.encode())
        self.unknown = self.library.unk_id()
        # Neighbours inside some piece. No merge reaches over any other pair of characters,
        # so a text may be cut between them and its parts encoded by themselves.
        self.bound = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self._pair_table()
        self.spaces_lead = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.bound)

    def _pair_table(self) -> None:
        """Every way to put a piece together from two symbols, as sorted keys with the piece's
        rank and symbol. Symbols are the pieces by number, then all other characters."""
        pieces = list(self.ids)
        symbol = {piece: k for k, piece in enumerate(pieces)}
        count = len(pieces)
        self.piece_ids = np.array([self.ids[piece] for piece in pieces], np.int64)
        self.characters = count + np.arange(0x110000, dtype=np.int64)
        for piece in pieces:
            if len(piece) == 1:
                self.characters[ord(piece)] = symbol[piece]
        self.span = count + 0x110000
        keys, made = [], []
        for piece in pieces:
            for k in range(1, len(piece)):
                halves = [
                    symbol.get(half, self.characters[ord(half)] if len(half) == 1 else None)
                    for half in (piece[:k], piece[k:])
                ]
                if None not in halves:
                    keys.append(int(halves[0]) * self.span + int(halves[1]))
                    made.append(piece)
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        ranks = np.array([self.ranks[piece] for piece in made], np.int32)[order]
        self.pair_ranks = np.append(ranks, self.never).astype(np.int32)
        self.pair_symbols = np.append(np.array([symbol[piece] for piece in made], np.int64)[order], -1)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs of symbols, and where they stand in the table."""
        keys = left * self.span + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], self.never), at

    def merge_all(self, texts: list[str]) -> list[tuple[int, ...]]:
        """Ids of texts in which spaces are already written as SPACE.

        Every pair of adjacent symbols that forms a piece waits in an agenda, best score
        first, leftmost first among equals. The best pair becomes one symbol, which forms
        new pairs with its neighbours. Short texts of one length take their steps together, a
        row of a matrix of symbols each, beside the matrix of the ranks that wait.
        """
        found: list[tuple[int, ...]] = [()] * len(texts)
        by_length: dict[int, list[int]] = {}
        for k, text in enumerate(texts):
            by_length.setdefault(len(text), []).append(k)
        for length, places in by_length.items():
            if length > SHORT:
                for k in places:
                    found[k] = self._ids_of(self._merge_long(texts[k]))
                continue
            for start in range(0, len(places) if length else 0, ROWS):
                rows = np.array(places[start : start + ROWS])
                group = np.array([texts[k] for k in rows.tolist()], f"<U{length}")
                symbols = self.characters[group.view(np.uint32).reshape(len(rows), length)]
                for done, final in self._merge_rows(rows, symbols):
                    for k, ids in zip(done.tolist(), self._numbers(final)):
                        found[k] = ids
        return found

    def _merge_rows(self, rows: np.ndarray, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        ranks, at = self._ranks_of(symbols[:, :-1], symbols[:, 1:])
        while ranks.shape[1]:
            best = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            waits = ranks[line, best] < self.never
            if not waits.all():
                yield rows[~waits], symbols[~waits]
                rows, symbols, ranks, at, best = rows[waits], symbols[waits], ranks[waits], at[waits], best[waits]
                line = line[: len(rows)]
            if not len(rows):
                return
            width = symbols.shape[1]
            pair = self.pair_symbols[at[line, best]]
            symbols[line, best] = pair
            left = np.arange(width - 1)
            symbols = np.take_along_axis(symbols, left + (left > best[:, None]), axis=1)
            gaps = np.arange(width - 2)
            keep = gaps + (gaps >= best[:, None])
            ranks, at = np.take_along_axis(ranks, keep, axis=1), np.take_along_axis(at, keep, axis=1)
            for gap, some in ((best - 1, best > 0), (best, best < width - 2)):
                here, gap = line[some], gap[some]
                ranks[here, gap], at[here, gap] = self._ranks_of(symbols[here, gap], symbols[here, gap + 1])
        yield rows, symbols

    def _numbers(self, symbols: np.ndarray) -> list[tuple[int, ...]]:
        known = symbols < len(self.piece_ids)
        ids = self.piece_ids[np.where(known, symbols, 0)].tolist()
        out = [tuple(row) for row in ids]
        for k in np.flatnonzero(~known.all(axis=1)).tolist():
            row: list[int] = []
            for symbol, piece in zip(symbols[k].tolist(), ids[k]):
                own = symbol < len(self.piece_ids)
                row += [piece] if own else self._other(chr(symbol - len(self.piece_ids)))
            out[k] = tuple(row)
        return out

    def _other(self, character: str) -> list[int]:
        """Ids of a character that is no piece."""
        if self.byte_ids:
            return [self.byte_ids[value] for value in character.encode()]
        return [self.unknown]

    def _ids_of(self, symbols: list[str]) -> tuple[int, ...]:
        out: list[int] = []
        for symbol in symbols:
            known = self.ids.get(symbol)
            out += [known] if known is not None else self._other(symbol)
        return tuple(out)

    def _merge_long(self, text: str) -> list[str]:
        """The agenda as a heap; entries whose symbols have changed meanwhile are skipped."""
        ranks = self.ranks
        symbols: list[str | None] = list(text)
        n = len(symbols)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        agenda = []

        def wait(left: int, right: int) -> None:
            pair = symbols[left] + symbols[right]
            if pair in ranks:
                heappush(agenda, (ranks[pair], left, right, pair))

        for k in range(n - 1):
            wait(k, k + 1)
        while agenda:
            _, left, right, pair = heappop(agenda)
            mine, other = symbols[left], symbols[right]
            if mine is None or other is None or after[left] != right or mine + other != pair:
                continue
            symbols[left], symbols[right] = pair, None
            following = after[left] = after[right]
            if following < n:
                before[following] = left
                wait(left, following)
            if before[left] >= 0:
                wait(before[left], left)
        return [symbol for symbol in symbols if symbol is not None]

    def parts(self, piece: str) -> list[str]:
        """A piece cut wherever no merge can reach over, so that its parts recur more."""
        bound, cuts = self.bound, [0]
        for k in range(1, len(piece)):
            if piece[k - 1 : k + 1] not in bound:
                cuts.append(k)
        cuts.append(len(piece))
        return [piece[a:b] for a, b in zip(cuts, cuts[1:])]

    def decode(self, ids: list[int]) -> str:
        """The text of ids without control pieces: surfaces joined, the leading space off."""
        joined = b"".join(map(self.surfaces.__getitem__, ids)).decode("utf-8", "replace")
        text = joined.replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


class Encoder:
    """Whole texts to ids and back, with a memory for pieces that recur.

    Of each piece the decimal ids, joined by commas, and the surface are kept, as bytes: those
    of a text are the pieces' joined. The last `most` pieces at least are held, and no more than
    `most_bytes` twice; a piece longer than `longest` only while its batch is worked on. Each
    piece is checked against the library, both ways, when it is new.
    """

    def __init__(
        self, vocabulary: MergeVocabulary, most: int = 300_000, most_bytes: int = 160 << 20, longest: int = 128
    ):
        self.vocabulary = vocabulary
        self.most, self.most_bytes, self.longest = most, most_bytes, longest
        self.decimal = [str(i).encode() for i in range(len(vocabulary.surfaces))]
        self.surfaces = [surface.replace(SPACE.encode(), b" ") for surface in vocabulary.surfaces]
        self.clear()
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.older_odd: set[str] = set()

    def clear(self) -> None:
        self.pieces: dict[str, tuple[bytes, bytes]] = {}
        self.odd: set[str] = set()  # pieces with unknown characters
        self.parts: dict[str, tuple[int, ...]] = {}
        self.held = 0

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces by those of their parts, of which the new ones are merged together."""
        cuts = [[p] if p[1:].isalpha() else self.vocabulary.parts(p) for p in pieces]
        new = list({part for parts in cuts for part in parts if part not in self.parts})
        self.parts.update(zip(new, self.vocabulary.merge_all(new)))
        found = [[i for part in parts for i in self.parts[part]] for parts in cuts]
        for part in new:
            if len(part) <= self.longest:
                self.held += 150 + 2 * len(part) + 8 * len(self.parts[part])
            else:
                del self.parts[part]
        return found

    def cut(self, text: str) -> list[str]:
        """The text with its spaces written as pieces write them, cut before each word."""
        if not text:
            return []
        if not self.vocabulary.spaces_lead:
            return [SPACE + text.replace(" ", SPACE)]
        words = text.replace(SPACE, " ").split(" ")
        if "" not in words:
            return [SPACE + word for word in words]
        return re.findall(f"{SPACE}+[^{SPACE}]*", SPACE + text.replace(" ", SPACE))

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces, and see that the library encodes and decodes them alike.

        The library puts its own space before a text, so a piece goes in without its first one.
        """
        known = {piece: self.older[piece] for piece in pieces if piece in self.older}
        new = [piece for piece in pieces if piece not in known]
        found, bare = self._ids(new), [piece[1:] for piece in new]
        told = self.vocabulary.library.encode(bare, num_threads=1)
        back = self.vocabulary.library.decode(found) if new else []
        decimal, surface, unknown = self.decimal, self.surfaces, self.vocabulary.unknown
        decimals = [b",".join([decimal[i] for i in own]) for own in found]
        surfaces = [b"".join([surface[i] for i in own]) for own in found]
        odd = {piece for piece, own in zip(new, found) if unknown in own}
        for piece, own, theirs, mine, text in zip(new, found, told, surfaces, back):
            # The library has no ids for an empty text.
            if (own != theirs and piece != SPACE) or (mine[1:] != text.encode() and piece not in odd):
                raise ValueError(f"the library encodes {piece!r} otherwise; is the model of type BPE?")
        self.odd |= odd
        self.odd |= self.older_odd.intersection(known)
        self.pieces.update(known)
        self.pieces.update(zip(new, zip(decimals, surfaces)))
        self.held += sum(2 * len(p) + len(self.pieces[p][0]) + len(self.pieces[p][1]) + 300 for p in pieces)

    def batch(self, texts: list[str]) -> Iterator[tuple[bytes, bytes, bool]]:
        """Of each text its decimal ids, joined by commas, its surface (all spaces as such, the
        leading one too), and whether it has unknown characters."""
        if len(self.pieces) >= self.most or self.held >= self.most_bytes:
            self.older, self.older_odd = self.pieces, self.odd
            self.clear()
        cut = [self.cut(text) for text in texts]
        held = [list(map(self.pieces.get, pieces)) for pieces in cut]
        new = {p for pieces, own in zip(cut, held) if None in own for p, one in zip(pieces, own) if one is None}
        with no_cycles():
            self._learn(new)
        look, odd = self.pieces.__getitem__, self.odd
        for pieces, own in zip(cut, held):
            if None in own:
                own = list(map(look, pieces))
            strange = bool(odd) and not odd.isdisjoint(pieces)
            yield b",".join([one[0] for one in own]), b"".join([one[1] for one in own]), strange
        for piece in new:
            if len(piece) > self.longest:
                del self.pieces[piece]
                self.odd.discard(piece)


def _encoder(model_path: str) -> Encoder:
    return Encoder(MergeVocabulary(model_path))


def worker_encoder(model_path: str) -> Encoder:
    """The encoder of a worker process; what it remembers serves the tasks that follow."""
    return kept_by_worker(_encoder, model_path)


def numbers(decimals: bytes) -> list[int]:
    return list(map(int, decimals.split(b","))) if decimals else []


def encode_texts(encoder: Encoder, texts: list[str]) -> list[list[int]]:
    """Ids of a batch of texts."""
    return [numbers(decimals) for decimals, _, _ in encoder.batch(texts)]


def decoded(vocabulary: MergeVocabulary, decimals: bytes, surface: bytes, odd: bool) -> bytes:
    """UTF-8 of the text that the ids stand for: the joined surfaces, the leading space off.

    Where unknown characters are among them the library decodes the whole text, and has to agree.
    """
    if not odd:
        return surface[1:] if surface[:1] == b" " else surface
    ids = numbers(decimals)
    text = vocabulary.library.decode(ids)
    if vocabulary.decode(ids) != text:
        raise ValueError("the library decodes otherwise")
    return text.encode()


def sentence_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode and decode every whole text: a row a document, in no order.

    doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of
    the text that decode(ids) gives), n_unknown. Null texts are empty ones, which have no
    ids. Repeated rows are encoded each; other columns are left out. An empty table gives no
    rows. Texts without spaces are one long piece, which is not kept.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(model_path)
        vocabulary, sha = encoder.vocabulary, hashlib.sha256
        for batch in batch_rows(batches, BATCH_BYTES):
            rows = [
                (
                    decimals.count(b",") + 1 if decimals else 0,
                    sha(decimals).hexdigest(),
                    sha(decoded(vocabulary, decimals, surface, odd)).hexdigest(),
                    numbers(decimals).count(vocabulary.unknown) if odd else 0,
                )
                for decimals, surface, odd in encoder.batch(texts_of(batch.column("text")))
            ]
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_unknown"],
            )

    return map_arrow(
        documents_of(docs),
        encode,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_unknown long",
    )
