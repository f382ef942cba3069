"""Operator 6, SentencePiece encoding and decoding by streaming Viterbi.

Texts are read from left to right. For each position the last piece of the best segmentation up to it is kept, in a window
as long as the longest piece; as soon as the backpointer paths of all positions in the window meet at one boundary, the
ids before it are final and leave the window. So memory does not grow with the text.

What "best" means depends on the model. In a unigram model it is the greatest sum of scores. In a BPE model it is the
segmentation that merging in order of rank gives: it is the one in which every two neighbours would be merged from their
own characters to just these two pieces, and exactly one piece can end each prefix in this way. The ids are those of the
library for either kind.

No piece joins a word to what follows it (checked when the model is read), so that the segmentation of a word does not
depend on its neighbours, and segmented words are remembered in each worker, up to a bound. New words of a BPE model are
segmented many at a time, one position of all of them after the other.

Defined results: null and empty texts have no ids and decode to the empty text; characters without a piece become byte
pieces; U+2581 is read as a space, as the library does; repeated rows are encoded row by row; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

SPACE = "▁"
_SPACED = re.compile(r" +[^ ]*")
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        number, kind = tag >> 3, tag & 7
        if kind == 0:
            yield number, varint()
        else:
            n = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield number, data[at : at + n]
            at += n


class Pieces:
    """A model's pieces: ids, scores and kinds; `bpe` tells the model's type, `prefix` whether a space is put in front."""

    def __init__(self, model: bytes):
        self.ids: dict[str, int] = {}
        self.names: list[str] = []
        self.score: list[float] = []
        self.bytes: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.unknown = 0
        self.bpe, self.prefix = False, True
        for number, value in _fields(model):
            if number == 1:
                self._piece(dict(_fields(value)))
            elif number == 2:
                self.bpe = dict(_fields(value)).get(3, 1) == 2
            elif number == 3:
                spec = dict(_fields(value))
                self.prefix = bool(spec.get(3, 1))
                if spec.get(2) or spec.get(4, 1):
                    raise ValueError("only models with the identity normaliser that keep all white space are supported")
        self.longest = max(map(len, self.ids), default=1)
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids if len(p) > 1):
            self.by_words = False  # pieces reach across words
            self.words = re.compile(r"(?s).+")
        else:
            self.by_words = True
            # neither does one join a letter to one of these marks after it
            before = {m: {p[k - 1] for p in self.ids for k in range(1, len(p)) if p[k] == m} for m in ".,;:!?"}
            marks = "".join(m for m, chars in before.items() if not any(c.isalpha() for c in chars))
            ended = f"{SPACE}*+[^\\W\\d_]++(?=[{marks}])|" if marks else ""
            self.words = re.compile(f"{ended}{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+")

    def _piece(self, field: dict) -> None:
        name = field[1].decode("utf-8")
        kind, i = field.get(3, _NORMAL), len(self.score)
        self.names.append(name)
        self.score.append(float(np.frombuffer(field.get(2, b"\0" * 4), "<f4")[0]))
        if kind == _BYTE:
            self.byte_ids[int(name[3:5], 16)] = i
            self.bytes.append(bytes([int(name[3:5], 16)]))
        elif kind == _NORMAL:
            self.ids[name] = i
            self.bytes.append(name.replace(SPACE, " ").encode("utf-8"))
        else:
            self.unknown = i if kind == _UNKNOWN else self.unknown
            self.bytes.append(" ⁇ ".encode() if kind == _UNKNOWN else b"")

    def fallback(self, char: str) -> list[int]:
        """Ids of a character without a piece."""
        raw = char.encode("utf-8", "surrogatepass")
        return [self.byte_ids[b] for b in raw] if all(b in self.byte_ids for b in raw) else [self.unknown]


class Neighbours:
    """Whether merging gives just the pieces a and b from their characters, for arrays of pairs.

    Where a piece ranks behind the two it is merged from, it appears when its rank is reached and goes when that of the
    piece merged from it is. So of the pieces along the seam of a and b those that are there together are known without
    merging, and the pair fails if one such couple makes a piece before either is used up by its own side.
    """

    SLOTS = 1 << 21

    def __init__(self, rank: np.ndarray, left: np.ndarray, right: np.ndarray, made: dict[tuple[int, int], int]):
        self.rank, self.left, self.right = rank, left, right
        pairs = sorted((a << 20 | b, rank[i]) for (a, b), i in made.items())
        self.keys = np.array([*(k for k, _ in pairs), np.iinfo(np.int64).max], np.int64)
        self.made_at = np.array([*(r for _, r in pairs), -1], np.int64)
        self.seen = np.full(self.SLOTS, -1, np.int64)  # twice the key, plus 1 where the pair holds

    @classmethod
    def of(cls, pieces: Pieces, merges: dict[str, tuple[int, int]]) -> tuple[Neighbours, list[str]]:
        """And the pieces, such as runs of spaces, that rank before one they are merged from or like another piece. What
        contains one of those is not to be asked for."""
        n, names, ids = len(pieces.names), pieces.names, pieces.ids
        order = sorted((i for name, i in ids.items() if len(name) > 1), key=lambda i: -pieces.score[i])
        rank = np.full(n, -1, np.int64)  # characters are there from the start
        rank[order] = np.arange(len(order))
        equal = Counter(pieces.score[i] for i in order)
        odd = {names[i] for i in order if equal[pieces.score[i]] > 1}
        left, right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        for name, (a, b) in merges.items():
            left[ids[name]], right[ids[name]] = a, b
            if max(rank[a], rank[b]) >= rank[ids[name]]:
                odd.add(name)
        made = {
            (ids[names[i][:k]], ids[names[i][k:]]): i for i in order for k in range(1, len(names[i])) if names[i][:k] in ids and names[i][k:] in ids
        }
        least = [o for o in odd if not any(o[j:k] in odd for j in range(len(o)) for k in range(j + 1, len(o) + 1) if k - j < len(o))]
        return cls(rank, left, right, made), least

    def hold(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 20 | b
        slot = (key * np.int64(0x5851F42D4C957F2D) >> np.int64(41)) & (self.SLOTS - 1)
        found = self.seen[slot]
        new = found >> 1 != key
        if new.any():
            keys, first, place = np.unique(key[new], return_index=True, return_inverse=True)
            value = keys << 1 | self._look(keys >> 20, keys & 0xFFFFF)
            self.seen[slot[new][first]] = value
            found[new] = value[place]
        return found & 1 == 1

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        good = np.ones(len(a), np.int64)
        at = np.arange(len(a))
        end_a = end_b = np.full(len(a), np.iinfo(np.int64).max)  # the ranks at which they are used up
        while len(at):
            key = a << 20 | b
            k = np.searchsorted(self.keys, key)
            made = self.made_at[k]
            bad = (self.keys[k] == key) & (made < end_a) & (made <= end_b)  # among equals the left one comes first
            good[at[bad]] = 0
            rank_a, rank_b = self.rank[a], self.rank[b]
            on = ~bad & ((rank_a >= 0) | (rank_b >= 0))
            back_a = rank_a > rank_b  # what came last goes first on the way back
            a, b, end_a, end_b = (
                np.where(back_a, self.right[a], a)[on],
                np.where(back_a, b, self.left[b])[on],
                np.where(back_a, rank_a, end_a)[on],
                np.where(back_a, end_b, rank_b)[on],
            )
            at = at[on]
        return good


class Endings:
    """For each position of a text the longest piece that ends there, by an automaton over arrays of texts."""

    def __init__(self, usable: dict[str, int], n_pieces: int):
        step: dict[int, int] = {}
        text, at_end = [""], {"": 0}
        for piece in sorted(usable):
            state = 0
            for k, char in enumerate(piece, 1):
                key = state << 21 | ord(char)
                if key not in step:
                    step[key] = len(text)
                    at_end[piece[:k]] = len(text)
                    text.append(piece[:k])
                state = step[key]

        def longest_of(name: str, table: dict[str, int], least: int) -> int:
            return next((table[name[k:]] for k in range(least, len(name)) if name[k:] in table), -1)

        self.back = np.array([max(longest_of(t, at_end, 1), 0) for t in text], np.int64)
        self.longest = np.array([longest_of(t, usable, 0) for t in text], np.int64)
        self.shorter = np.full(n_pieces, -1, np.int64)
        for name, i in usable.items():
            self.shorter[i] = longest_of(name, usable, 1)
        self.keys = np.array([*sorted(step), np.iinfo(np.int64).max], np.int64)
        self.next = np.array([*(step[k] for k in sorted(step)), 0], np.int64)

    def step(self, state: np.ndarray, chars: np.ndarray) -> np.ndarray:
        out, at = np.zeros(len(state), np.int64), np.arange(len(state))
        while len(at):
            key = state << 21 | chars
            k = np.searchsorted(self.keys, key)
            hit = self.keys[k] == key
            out[at[hit]] = self.next[k[hit]]
            on = ~hit & (state != 0)
            at, state, chars = at[on], self.back[state[on]], chars[on]
        return out


class Encoder:
    """Streaming Viterbi over one model."""

    def __init__(self, pieces: Pieces, remembered: int = 200_000):
        self.pieces = pieces
        self.bound = remembered
        self.known: dict[str, bytes] = {}
        self.word_ids: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.length = [len(p) for p in pieces.names]
        # a piece that its own characters do not merge to is never used
        merges: dict[str, list[tuple[int, int]]] = {p: [] for p in pieces.ids}
        usable = {p: i for p, i in pieces.ids.items() if not pieces.bpe or self._merged(p, merges[p]) == [i]}
        self.missing = min(pieces.score, default=0.0) - 10.0  # the score of a character without a piece
        # the ends of pieces: the id of a piece, -1 for what is only the end of longer ones
        self.endings = {name[k:]: -1 for name in usable for k in range(1, len(name))} | usable
        self.side_by_side = pieces.bpe and len(pieces.names) < 1 << 20
        if self.side_by_side:
            self.neighbours, odd = Neighbours.of(pieces, {p: merges[p][-1] for p in usable if merges[p]})
            self.odd = re.compile("|".join(map(re.escape, odd)) or "(?!)")
            self.lengths = np.array(self.length, np.int64)
            self.automaton = Endings(usable, len(pieces.names))

    def _merged(self, text: str, merges: list[tuple[int, int]] | None = None) -> list[int | None]:
        """Characters merged in order of score, the leftmost first among equals; None for a character without a piece.
        The pairs merged are added to `merges`."""
        ids, names, score = self.pieces.ids, self.pieces.names, self.pieces.score
        parts = [ids.get(c) for c in text]

        def joined(k: int) -> int | None:
            a, b = parts[k], parts[k + 1]
            return None if a is None or b is None else ids.get(names[a] + names[b])

        pairs = [joined(k) for k in range(len(parts) - 1)]
        while pairs:
            found = [(-score[i], k) for k, i in enumerate(pairs) if i is not None]
            if not found:
                break
            at = min(found)[1]
            if merges is not None:
                merges.append((parts[at], parts[at + 1]))
            parts[at : at + 2] = [pairs[at]]
            del pairs[at]
            for k in (at - 1, at):
                if 0 <= k < len(pairs):
                    pairs[k] = joined(k)
        return parts

    def _step(self, text: str, end: int, base: int, last: list[int], best: list[float]) -> None:
        """Appends the piece that ends at `end` and the sum of scores; -end stands for a character without a piece."""
        endings, score, pairs = self.endings.get, self.pieces.score, self.pairs
        # the pieces that end here, the longest last; no piece ends in what is not the end of any
        start, ending = end - 1, []
        while start >= base and (i := endings(text[start:end])) is not None:
            if i >= 0:
                ending.append((start, i))
            start -= 1
        found, top = -end, 0.0
        if self.pieces.bpe:
            for start, i in reversed(ending):
                before = last[start - base]
                key = before << 32 | i
                if before < 0 or (fits := pairs.get(key)) or fits is None and self._first_look(key):
                    found = i
                    break
        else:
            top = best[end - 1 - base] + self.missing
            for start, i in reversed(ending):
                if (total := best[start - base] + score[i]) > top:
                    found, top = i, total
        last.append(found)
        best.append(top)

    def stream(self, text: str) -> Iterator[list[int]]:
        """Ids of pieces, yielded as far as they are final; -1 - k stands for a character without a piece at position k."""
        base = 0  # all before it is final
        last = [-1]  # for each position of the window the piece that ends there
        best = [0.0]  # and the sum of scores up to it
        for end in range(1, len(text) + 1):
            self._step(text, end, base, last, best)
            if end - base >= 4 * self.pieces.longest:
                final = self._meeting(last, base, end)
                if final > base:
                    yield self._path(last, base, final)
                    last, best, base = last[final - base :], best[final - base :], final
        yield self._path(last, base, len(text))

    def _side_by_side(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, all of which go on together from position to position. The longest must come first."""
        n = np.array([len(w) for w in words])
        width = int(n[0])
        chars = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
        chars = np.ascontiguousarray(chars.reshape(-1, width).T).astype(np.int64)
        last = np.full((width + 1, len(words)), -1, np.int64)
        state = np.zeros(len(words), np.int64)
        for end in range(1, width + 1):
            live = int(np.searchsorted(-n, -end, side="right"))
            state = self.automaton.step(state[:live], chars[end - 1, :live])
            last[end, :live] = -end
            piece = self.automaton.longest[state]
            at = np.flatnonzero(piece >= 0)
            piece = piece[at]
            while len(at):
                before = last[end - self.lengths[piece], at]
                fits = before < 0
                asked = np.flatnonzero(~fits)
                fits[asked] = self.neighbours.hold(before[asked], piece[asked])
                last[end, at[fits]] = piece[fits]
                piece, at = self.automaton.shorter[piece[~fits]], at[~fits]
                piece, at = piece[piece >= 0], at[piece >= 0]
        path = np.full((len(words), width), -1, np.int32)
        odd, left, at, column = set(), n.copy(), np.arange(len(words)), width
        count = np.zeros(len(words), np.int64)
        while len(at):
            column -= 1
            piece = last[left[at], at]
            path[at, column] = piece
            count[at] += 1
            odd.update(at[piece < 0].tolist())
            left[at] -= np.where(piece < 0, 1, self.lengths[piece])
            at = at[left[at] > 0]
        flat = path[np.arange(width) >= width - count[:, None]].tobytes()
        ends = (np.cumsum(count) * 4).tolist()
        done = dict(zip(words, (flat[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        for k in odd:
            done[words[k]] = self._ids(words[k], path[k, width - count[k] :].tolist())
        return done

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words, side by side where the model allows it and long ones as streams. Else in order of the alphabet,
        so that each goes on from what it shares with the one before."""
        if len(self.pairs) > 2_000_000:
            self.pairs.clear()
        if self.side_by_side:
            some = sorted((w for w in words if len(w) <= 64 and not self.odd.search(w)), key=len, reverse=True)
            done = {w: self._ids(w, chain.from_iterable(self.stream(w))) for w in words.difference(some)}
            for at in range(0, len(some), 16_384):
                done.update(self._side_by_side(some[at : at + 16_384]))
            return done
        done, at, last, best = {}, "", [-1], [0.0]
        for word in sorted(words):
            if len(word) > 64:
                done[word] = self._ids(word, (i for final in self.stream(word) for i in final))
                continue
            same = 0
            for a, b in zip(at, word, strict=False):
                if a != b:
                    break
                same += 1
            del last[same + 1 :], best[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                self._step(word, end, 0, last, best)
            at = word
            done[word] = self._ids(word, self._path(last, 0, len(word)))
        return done

    def _ids(self, word: str, pieces: Iterable[int]) -> bytes:
        out: list[int] = []
        for i in pieces:
            if i < 0:
                out += self.pieces.fallback(word[-i - 1])
            else:
                out.append(i)
        return array("i", out).tobytes()

    def _first_look(self, key: int) -> bool:
        a, b = key >> 32, key & 0xFFFFFFFF
        fits = self.pairs[key] = self._merged(self.pieces.names[a] + self.pieces.names[b]) == [a, b]
        return fits

    def _back(self, piece: int) -> int:
        return 1 if piece < 0 else self.length[piece]

    def _meeting(self, last: list[int], base: int, end: int) -> int:
        """The last boundary that the paths of all positions which may still be continued have in common."""
        heads = set(range(end - self.pieces.longest + 1, end + 1))
        while len(heads) > 1:
            at = max(heads)
            if at <= base:
                return base
            heads.discard(at)
            heads.add(at - self._back(last[at - base]))
        return max(heads.pop(), base)

    def _path(self, last: list[int], base: int, end: int) -> list[int]:
        out = []
        while end > base:
            out.append(last[end - base])
            end -= self._back(out[-1])
        return out[::-1]

    def _split(self, text: str) -> list[str]:
        """Parts between spaces. A part stands for itself after one space; after several it has them in front."""
        text = text.replace(SPACE, " ")
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [p[1:] if p[1:2] != " " and len(p) > 1 else p for p in _SPACED.findall(" " + text)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as 32-bit integers."""
        if not (self.pieces.by_words and self.pieces.prefix):
            front = SPACE if self.pieces.prefix else ""
            spaced = [front + t.replace(" ", SPACE) if t else "" for t in texts]
            return [self._ids(t, (i for final in self.stream(t) for i in final)) for t in spaced]
        split = [self._split(t) if t else [] for t in texts]
        known, word_ids = self.known, self.word_ids
        missing = set(chain.from_iterable(split)).difference(known)
        if len(known) + len(missing) > self.bound:
            known.clear()
            missing = set(chain.from_iterable(split))
        words = {p: self.pieces.words.findall((p if p[0] == " " else " " + p).replace(" ", SPACE)) for p in missing}
        fresh = set(chain.from_iterable(words.values())).difference(word_ids)
        if len(word_ids) + len(fresh) > 2 * self.bound:
            word_ids.clear()
            fresh = set(chain.from_iterable(words.values()))
        word_ids.update(self._learn(fresh))
        known.update((p, b"".join(map(word_ids.__getitem__, some))) for p, some in words.items())
        made = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for part in missing:  # long ones are not remembered
            if len(part) > 64:
                del known[part]
        for word in fresh:
            if len(word) > 64:
                del word_ids[word]
        return made


_ENCODERS: dict[bytes, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    """The worker's encoder of this model; workers go on to further tasks with what they remember."""
    key = hashlib.sha256(model).digest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(Pieces(model))
    return _ENCODERS[key]


def decode(pieces: Pieces, lists: pa.ListArray) -> pa.Array:
    """The text of each list of ids; null for null. What is not UTF-8 becomes U+FFFD."""
    offsets = lists.offsets.to_numpy()
    at = offsets - offsets[0]
    ids = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    parts = pa.array(pieces.bytes, pa.large_binary()).take(ids)
    ends = np.frombuffer(parts.buffers()[1], np.int64, len(parts) + 1, parts.offset * 8)[at] if len(parts) else np.zeros(len(at), np.int64)
    data = parts.buffers()[2] if len(parts) else None
    raw = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends), data or pa.py_buffer(b"")])
    if pieces.prefix:
        raw = pc.if_else(pc.starts_with(raw, " "), pc.binary_replace_slice(raw, 0, 1, b""), raw)
    try:
        text = raw.cast(pa.string())
    except pa.ArrowInvalid:
        text = pa.array([t.decode("utf-8", "replace") for t in raw.to_pylist()], pa.string())
    return pc.if_else(lists.is_valid(), text, pa.scalar(None, pa.string()))


def _pieces_of(docs: DataFrame, model_path: str):
    with open(model_path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decoded_col: str | None = None) -> DataFrame:
    """One row per document: doc_id, the `keep` columns, n_tokens, ids. With `decoded_col` also the text of the ids, decoded in
    the same pass."""
    shared = _pieces_of(docs, model_path)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *[F.col(f"`{c}`") for c in keep], F.col(text_col).alias("text_to_encode"))
    n = len(keep) + 1
    schema = type(rows.schema)(rows.schema.fields[:n]).add("n_tokens", "long").add("ids", ArrayType(IntegerType()))
    if decoded_col:
        schema = schema.add(decoded_col, "string")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                made = encoder.encode([t or "" for t in part.column(n).to_pylist()])
                counts = np.array([len(m) // 4 for m in made], np.int64)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), np.int32)))
                columns = [*(part.column(i) for i in range(n)), pa.array(counts), ids]
                if decoded_col:
                    columns.append(decode(encoder.pieces, ids))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """The rows with their ids decoded in a further column; null ids decode to null."""
    shared = _pieces_of(encoded, model_path)
    at = encoded.columns.index(ids_col)
    schema = type(encoded.schema)(list(encoded.schema.fields)).add(out_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                yield pa.RecordBatch.from_arrays([*part.columns, decode(pieces, part.column(at))], names=[*batch.schema.names, out_col])

    return encoded.mapInArrow(run, schema)
