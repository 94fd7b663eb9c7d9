"""Encoding and decoding by a trained merge-type (BPE) piece model, exactly as the sentencepiece library does.

Merging joins, again and again, the two neighbours whose join is the best piece of the vocabulary, the leftmost of equals. Its
result is the one sequence in which every piece is what its own characters merge to, and every two neighbours are what the
characters of both merge to. So a text needs no merging of its own:

1. An Aho-Corasick automaton tells the longest piece that begins at each place.
2. From the left, take the longest piece that is compatible with the piece before; on failure, its longest prefix that is a piece.
3. If none is left, mark the place in a bitfield of failed places and give up the piece before. What comes before a place is the
   same whatever follows, so no place fails twice and the work is linear in the text.
4. Two pieces are compatible if their characters, merged again, give these two. Answers are kept, as most pairs come again.

Where no piece has a space behind another character, or a letter beside a mark, no merge crosses such a place: the text is cut there, and
the ids of short stretches are kept in a bounded table. Which characters are told apart so is taken from the pieces. Characters that no
piece holds become their UTF-8 bytes.

The model's normaliser must be the identity, with a space in front of the text and no removal of spaces; others are refused.

Defined results: null text is empty; an empty text has no ids and decodes to the empty text; null ids decode to null. Very long texts
are encoded whole. Equal rows give equal rows; an empty table gives an empty one. Other columns are carried, whatever their names;
a column with the name of the result is refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import groupby
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.llm.common import text_chunks

#: Fixed value: the character that stands for a space in pieces.
SPACE = "▁"
#: Stretches whose ids are kept: characters at most, and how many; answers about pairs that are kept.
SHORT, KEPT, PAIRS = 48, 200_000, 1_000_000
#: Ids that a task decodes at a time; a longer row is taken whole.
CHUNK_IDS = 1 << 18


@dataclass
class Vocabulary:
    """What encoding needs of a model: all pieces by id, the place of each in the order of merging, and the ids of bytes."""

    pieces: list[str]
    order: dict[str, int]  # pieces that merging can make: the least is merged first, equal ones from the left
    bytes_: list[int]
    silent: set[int]
    unknown: int
    unknown_text: str

    @cached_property
    def ids(self) -> dict[str, int]:
        return {p: i for i, p in enumerate(self.pieces) if p in self.order}

    @cached_property
    def whole(self) -> set[str]:
        """Pieces that their own characters merge to; no other can ever appear."""
        return {p for p in self.order if self.merged(p) == [p]}

    def merged(self, text: str) -> list[str]:
        """What the characters of a text merge to, by the definition; its cost is square in the text."""
        parts, order = list(text), self.order
        while len(parts) > 1:
            best = min(((order.get(a + b, len(order)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] == len(order):
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts


def load(path: str) -> Vocabulary:
    """Read a model file of the sentencepiece library. The driver reads it, and tasks get what they need of it (under 2 MB)."""
    import sentencepiece as spm
    from sentencepiece import sentencepiece_model_pb2 as proto

    data = Path(path).read_bytes()
    model, own = proto.ModelProto(), spm.SentencePieceProcessor(model_proto=data)
    model.ParseFromString(data)
    how, trained = model.normalizer_spec, model.trainer_spec
    plain = not how.precompiled_charsmap and how.add_dummy_prefix and not how.remove_extra_whitespaces and how.escape_whitespaces
    if not plain or trained.model_type != trained.BPE or trained.treat_whitespace_as_suffix or not trained.byte_fallback:
        raise ValueError(f"{path}: only merge-type models with byte fallback, identity normaliser and a space in front are read")
    pieces = [own.id_to_piece(i) for i in range(own.get_piece_size())]
    kinds = {i: p.type for i, p in enumerate(model.pieces)}
    one = model.pieces[0]
    if any(kind in (one.USER_DEFINED, one.UNUSED) for kind in kinds.values()):
        raise ValueError(f"{path}: models with user-defined or unused pieces aren't read")
    normal = [i for i in kinds if kinds[i] == one.NORMAL]
    place = {s: k for k, s in enumerate(sorted({own.get_score(i) for i in normal}, reverse=True))}
    order = {pieces[i]: place[own.get_score(i)] for i in normal}
    if any(c not in order for p in order for c in p):
        raise ValueError(f"{path}: a character of some piece is no piece of its own")
    made = Vocabulary(pieces, order, [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)], {i for i in kinds if kinds[i] == one.CONTROL}, own.unk_id(), trained.unk_surface)
    made.whole  # found once, here
    return made


def _stretches(whole: set[str]) -> str:
    """A pattern of stretches that no merge leaves: spaces and what follows them, up to the next space or change of kind.

    Characters that stand side by side in some piece are of one kind, and so on from one to the next. Marks are all kinds that
    ASCII characters but no ASCII letters belong to, and ASCII characters without a piece; the rest is of the other kind.
    """
    if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in whole):
        return "(?s).+"
    kind: dict[str, str] = {}

    def of(c: str) -> str:
        while kind.setdefault(c, c) != c:
            c = kind[c]
        return c

    for p in whole:
        for a, b in zip(p, p[1:], strict=False):
            if SPACE not in (a, b):
                kind[of(a)] = of(b)
    known = set("".join(whole)) - {SPACE}
    letters = {of(c) for c in known if c.isascii() and c.isalpha()}
    plain = {of(c) for c in known if c.isascii()} - letters
    marks = {c for c in known if of(c) in plain} | {chr(c) for c in range(128) if chr(c) not in known}
    marks = "".join(map(re.escape, sorted(marks)))
    return f"{SPACE}*[^{SPACE}{marks}]+|{SPACE}*[{marks}]+|{SPACE}+" if marks else f"{SPACE}*[^{SPACE}]+|{SPACE}+"


class Encoder:
    """Encodes texts by backtracking; one a worker."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        v, self.v = vocabulary, vocabulary
        self.known = set("".join(v.whole))
        self.size = [len(p) for p in v.pieces]
        self.automaton = ahocorasick.Automaton()
        self.single = {p: v.ids[p] for p in v.whole if len(p) == 1}
        for piece in v.whole:
            if len(piece) > 1:  # of single characters each place has one, which needs no search
                self.automaton.add_word(piece, v.ids[piece])
        self.automaton.make_automaton()
        # the longest prefix of a piece that is a piece; -1: there is none
        self.shorter = [next((v.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in v.whole), -1) if p in v.whole else -1 for p in v.pieces]
        self.stretches = re.compile(_stretches(v.whole)).findall
        self.kept: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        """Whether the characters of two neighbours, merged again, give these two. The answer is kept."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        found = self.pairs[a << 32 | b] = self._apart(self.v.pieces[a], self.v.pieces[b])
        return found

    def _apart(self, x: str, y: str) -> bool:
        """Whether no merge of the characters of both joins the two sides. Each side alone merges to itself, so then both are left."""
        order, parts, edge = self.v.order, [*x, *y], len(x)
        none = len(order)
        ranks = [order.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best = min(ranks)
            i = ranks.index(best)
            if best == none:
                return True
            if i == edge - 1:
                return False
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = order.get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = order.get(parts[i] + parts[i + 1], none)
            edge -= i < edge - 1

    def backtracked(self, text: str) -> list[int]:
        """The ids of a text whose characters are all pieces."""
        n, size, shorter, pairs = len(text), self.size, self.shorter, self.pairs
        longest = [*map(self.single.__getitem__, text), -1]
        for end, piece in self.automaton.iter(text):  # ends ascend, so the last one found from a place is the longest
            longest[end + 1 - size[piece]] = piece
        failed, any_failed, out, last, at, piece = bytearray(n // 8 + 1), False, [], -1, 0, longest[0]
        while at < n:
            while piece >= 0:
                end = at + size[piece]
                if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | piece)
                    if fits or fits is None and self.compatible(last, piece):
                        break
                piece = shorter[piece]
            if piece < 0:
                failed[at >> 3] |= 1 << (at & 7)
                any_failed, piece = True, out.pop()
                at -= size[piece]
                last = out[-1] if out else -1
            else:
                out.append(piece)
                at, last, piece = end, piece, longest[end]
        return out

    def stretch(self, text: str) -> tuple[int, ...]:
        if self.known.issuperset(text):
            return tuple(self.backtracked(text))
        out = []
        for known, run in groupby(text, self.known.__contains__):
            run = "".join(run)
            out += self.backtracked(run) if known else [self.v.bytes_[b] for b in run.encode()]
        return tuple(out)

    def encode(self, text: str, into: list[int]) -> None:
        """Append the ids of a text."""
        if not text:
            return
        kept = self.kept
        for s in self.stretches(SPACE + text.replace(" ", SPACE)):
            found = kept.get(s)
            if not found:
                found = self.stretch(s)
                if len(s) <= SHORT:
                    if len(kept) >= KEPT:
                        kept.clear()
                    kept[s] = found
            into.extend(found)


class Decoder:
    """Decodes many rows of ids at once from a table of all pieces' bytes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        v, self.v = vocabulary, vocabulary
        self.byte_of = np.full(len(v.pieces), -1)
        self.byte_of[v.bytes_] = np.arange(256)
        inner = [self._text(i, p.replace(SPACE, " ")) for i, p in enumerate(v.pieces)]
        # at the beginning of a text one space is left out
        front = [self._text(i, p.removeprefix(SPACE).replace(SPACE, " ")) for i, p in enumerate(v.pieces)]
        self.size = np.array([len(x) for x in inner + front])
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.data = np.frombuffer(b"".join(inner + front), np.uint8)

    def _text(self, i: int, piece: str) -> bytes:
        if self.byte_of[i] >= 0:
            return bytes([self.byte_of[i]])
        return b"" if i in self.v.silent else self.v.unknown_text.encode() if i == self.v.unknown else piece.encode()

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all rows, one after the other, where each begins, and the bytes of each piece. Row k has ids[begin[k]:begin[k + 1]]."""
        n, front, filled = len(self.v.pieces), ids.astype(np.int64), np.flatnonzero(np.diff(begin))
        first = begin[filled]
        while len(first):  # pieces without text leave the next one at the beginning, as long as there is one
            front[first] = ids[first] + n
            go = (self.size[front[first]] == 0) & (first + 1 < begin[filled + 1]) & ~self._took(ids[first])
            first, filled = first[go] + 1, filled[go]
        size = self.size[front]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = self.data[np.repeat(self.start[front] - ends[:-1], size) + np.arange(ends[-1])]
        return out, ends[begin], size

    def _took(self, ids: np.ndarray) -> np.ndarray:
        """Whether a piece without text at the beginning has used up the one space that is left out."""
        return np.array([self.v.pieces[i].startswith(SPACE) for i in ids], bool)

    def sound(self, ids: np.ndarray, size: np.ndarray, data: bytes) -> bytes:
        """The bytes of one row. Of a run of byte pieces, each byte that is part of no character becomes U+FFFD."""
        single = self.byte_of[ids] >= 0
        if not single.any():
            return data
        at, out = 0, []
        edges = np.flatnonzero(np.diff(single)) + 1
        for a, b in zip([0, *edges], [*edges, len(ids)], strict=True):
            n = int(size[a:b].sum())
            out.append(_characters(data[at : at + n]) if single[a] else data[at : at + n])
            at += n
        return b"".join(out)


def _characters(data: bytes) -> bytes:
    out = []
    while True:
        try:
            data.decode()
            return b"".join([*out, data])
        except UnicodeDecodeError as wrong:
            out += [data[: wrong.start], b"\xef\xbf\xbd"]
            data = data[wrong.start + 1 :]


_made: dict[tuple, object] = {}


def _one(kind: type, key: str, vocabulary: Vocabulary) -> object:
    """One encoder or decoder of a vocabulary a worker."""
    if (kind, key) not in _made:
        _made.clear() if len(_made) > 8 else None
        _made[kind, key] = kind(vocabulary)
    return _made[kind, key]


@lru_cache(maxsize=4)
def _loaded(path: str) -> Vocabulary:
    return load(path)


def _with(df: DataFrame, into: str, kind: T.DataType, keep: list[str] | None) -> tuple[list[str], T.StructType]:
    carried = df.columns if keep is None else keep
    if into.lower() in (c.lower() for c in carried):
        raise ValueError(f"there is a column {into} already")
    return carried, T.StructType([*(df.schema[c] for c in carried), T.StructField(into, kind)])


def encoded(docs: DataFrame, model: str, text_col: str = "text", into: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns keep of docs (all, if None) and the ids of the text. model: path of the model file on the driver."""
    carried, schema = _with(docs, into, T.ArrayType(T.IntegerType()), keep)
    shipped = docs.sparkSession.sparkContext.broadcast(_loaded(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _one(Encoder, model, shipped.value)
        for batch in batches:
            for a, b, raw, offsets in text_chunks(batch.column(0)):
                ids: list[int] = []
                begin, data = [0], raw.tobytes()
                for x, y in zip(offsets[:-1], offsets[1:], strict=True):
                    encoder.encode(data[x:y].decode(), ids)
                    begin.append(len(ids))
                made = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(np.array(ids, np.int32)))
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[1:]), made], schema.names)

    return _numbered(docs, text_col, "string", carried).mapInArrow(run, schema)


def decoded(rows: DataFrame, model: str, ids_col: str = "ids", into: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """The columns keep of rows (all, if None) and the text that the ids decode to."""
    carried, schema = _with(rows, into, T.StringType(), keep)
    shipped = rows.sparkSession.sparkContext.broadcast(_loaded(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _one(Decoder, model, shipped.value)
        for batch in batches:
            lists, a = batch.column(0), 0
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            while a < batch.num_rows:
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + CHUNK_IDS, "right")) - 1)
                part, begin = ids[ends[a] : ends[b]], ends[a : b + 1] - ends[a]
                data, at, size = decoder.decode(part, begin)
                data = data.tobytes()
                texts = [decoder.sound(part[i:j], size[i:j], data[x:y]) for i, j, x, y in zip(begin[:-1], begin[1:], at[:-1], at[1:], strict=True)]
                none = lists.slice(a, b - a).is_null().to_pylist()
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[1:]), pa.array([None if z else t for z, t in zip(none, texts, strict=True)], pa.binary()).cast(pa.string())], schema.names)
                a = b

    return _numbered(rows, ids_col, "array<int>", carried).mapInArrow(run, schema)


def _numbered(df: DataFrame, first: str, kind: str, carried: list[str]) -> DataFrame:
    """The input column first, then those that are carried, under names that can't clash."""
    return df.select(F.col(f"`{first}`").cast(kind).alias("0"), *(F.col(f"`{c}`").alias(str(k + 1)) for k, c in enumerate(carried)))


def report(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document: encoded, then decoded from the ids."""
    back = decoded(encoded(docs, model, keep=["doc_id"]), model)
    ids = F.col("ids")
    return back.select("doc_id", F.size(ids).cast("long").alias("n_tokens"), F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
