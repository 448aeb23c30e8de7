"""Token counts by finite-state transducers compiled from a BPE vocabulary.

Two deterministic transducers work one after the other.

*Pieces.*  A small machine over character classes reproduces the byte-level
pre-tokenizer; its transitions are annotated with the piece borders they
reveal (before this character, before the last one).  A text is cut into
equal chunks; each chunk's map from every state to its end state is
computed, the maps are composed by a parallel prefix scan, and a second pass
from the now known states emits the borders.

*Tokens.*  Inside a piece, a machine over bytes emits token counts.  The BPE
encoding of a prefix is that of a shorter prefix plus one last token, which
is the only token ending there that may follow the shorter prefix's last
one.  A state keeps the last tokens of the recent prefixes; a transition
carries the change in the number of tokens, so the sum along a piece is its
token count.  States and transitions are compiled when first met and kept.

Defined results: a null text is empty and has no tokens; strings of special
tokens in a text count as one token each, as the library does by default;
texts of any length are processed whole; repeated rows get equal counts; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Character classes.  Contraction letters have classes of their own.
OTHER_LETTER, QUICK, R, V, L, E, NUMBER, BLANK, SPACE, QUOTE, OTHER = range(11)
CLASSES = 11
PAD = 2 * CLASSES  # leaves the state as it is
# States: nothing read, letters, digits, other characters, a quote that
# begins a piece, the same with r / v / l after it, a finished contraction,
# one blank, one other space, several spaces ending in a blank / other space.
START, LETTERS, DIGITS, OTHERS, Q, QR, QV, QL, DONE, B1, S1, BN, SN = range(13)
STATES = 13
HERE, BACK = 1, 2  # borders: before this character, before the last one
# Code points that match \s.
SPACES = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def piece_machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, border mask), indexed by [class, state].  Classes from
    CLASSES on are the same characters at the start of a text."""
    letters = {OTHER_LETTER, QUICK, R, V, L, E}
    spaces = {BLANK: B1, SPACE: S1}
    begin = {c: LETTERS for c in letters} | {NUMBER: DIGITS, QUOTE: Q, OTHER: OTHERS} | spaces
    run = {c: LETTERS for c in letters} | {NUMBER: DIGITS, QUOTE: OTHERS, OTHER: OTHERS}
    to = np.zeros((2 * CLASSES + 1, STATES), dtype=np.uint8)
    mask = np.zeros_like(to)
    to[PAD] = np.arange(STATES)
    for state in range(STATES):
        for c in range(CLASSES):
            border, nxt = HERE, begin[c]
            if state in (LETTERS, DIGITS, OTHERS) and c not in spaces and run[c] == state:
                border, nxt = 0, state
            elif state == Q and c in (QUICK, R, V, L):
                border, nxt = 0, {QUICK: DONE, R: QR, V: QV, L: QL}[c]
            elif state == Q and c in (QUOTE, OTHER):
                border, nxt = 0, OTHERS
            elif state in (QR, QV, QL):
                if (state, c) in ((QR, E), (QV, E), (QL, L)):
                    border, nxt = 0, DONE
                elif c in letters:
                    border, nxt = BACK, LETTERS  # no contraction: the letter began a piece
                else:
                    border, nxt = BACK | HERE, begin[c]
            elif state in (B1, S1, BN, SN) and c in spaces:
                border, nxt = 0, BN if c == BLANK else SN
            elif state == B1:
                border, nxt = 0, run[c]  # the blank joins what follows
            elif state == BN:
                border, nxt = BACK, run[c]
            elif state == SN:
                border, nxt = BACK | HERE, begin[c]
            to[c, state], mask[c, state] = nxt, border
            to[c + CLASSES, state] = begin[c]
            mask[c + CLASSES, state] = HERE | (BACK if state in (QR, QV, QL) else 0)
    return to, mask


def class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            table[i] = OTHER_LETTER
        elif kind == "N":
            table[i] = NUMBER
    table[list(SPACES)] = SPACE
    table[32] = BLANK
    table[ord("'")] = QUOTE
    for letter in "stmd":
        table[ord(letter)] = QUICK
    for letter, c in (("r", R), ("v", V), ("l", L), ("e", E)):
        table[ord(letter)] = c
    return table


class Pieces:
    """The piece machine, run over many characters at once."""

    CHUNK = 128

    def __init__(self, classes: np.ndarray) -> None:
        to, mask = piece_machine()
        self.to, self.mask = to.ravel(), mask.ravel()
        self.classes = classes

    def starts(self, text: str, firsts: np.ndarray) -> np.ndarray:
        """Code-point positions where pieces start in concatenated texts;
        ``firsts``: where each (non-empty) text starts."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        n = len(codes)
        chunks = n // self.CHUNK + 1
        c = np.full(chunks * self.CHUNK, PAD, dtype=np.int64)
        c[:n] = self.classes[codes]
        c[firsts] += CLASSES
        c[n] = OTHER + CLASSES  # closes the last text
        c = c.reshape(chunks, self.CHUNK) * STATES
        maps = np.tile(np.arange(STATES), (chunks, 1))
        for k in range(self.CHUNK):
            maps = self.to[c[:, k, None] + maps]
        step = 1
        while step < chunks:  # compose: every map after all maps before it
            maps = np.concatenate([maps[:step], np.take_along_axis(maps[step:], maps[:-step].astype(np.int64), axis=1)])
            step *= 2
        state = np.concatenate([[START], maps[:-1, START]]).astype(np.int64)
        borders = np.empty((chunks, self.CHUNK), dtype=np.uint8)
        for k in range(self.CHUNK):
            at = c[:, k] + state
            borders[:, k] = self.mask[at]
            state = self.to[at].astype(np.int64)
        borders = borders.ravel()
        found = (borders[:n] & HERE) | (borders[1:n + 1] & BACK) >> 1
        return np.flatnonzero(found)


class Tokens:
    """The byte machine of a BPE vocabulary, compiled as it is met."""

    MOST = 1_200_000  # states and pieces kept before starting over

    def __init__(self, vocab: dict[str, int], merges: list) -> None:
        to_byte = {c: b for b, c in byte_characters().items()}
        self.ids = {bytes(to_byte[c] for c in t): i for t, i in vocab.items() if all(c in to_byte for c in t)}
        self.bytes = {i: b for b, i in self.ids.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.merge = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.ids))
        self.reach: dict[bytes, int] = {}  # longest token by its last three bytes
        for t in self.ids:
            if len(t) > 2:
                self.reach[t[-3:]] = max(len(t), self.reach.get(t[-3:], 2))
        self.split: dict[int, tuple[int, tuple[int, int]]] = {}
        for pair, (rank, made) in self.merge.items():
            self.split.setdefault(made, (rank, pair))
        self.alone: dict[int, bool] = {}
        self.edges: dict[int, list[tuple[int, float]]] = {}
        self.clear()

    def clear(self) -> None:
        # State 0: nothing read.  A state stands for the prefixes that lead to
        # it: their last token and tokens so far.  Pieces longer than a token
        # have states of their own, with the recent bytes and the state of the
        # prefix one byte shorter.
        self.last, self.total = [-1], [0]
        # By state * 256 + byte: the next state * 256 + the change in tokens + 128.
        self.moves: dict[int, int] = {}
        self.long_last, self.long_total, self.recent, self.shorter = [-1], [0], [b""], [0]
        self.long_moves: dict[int, int] = {}
        self.merged: dict[tuple, int] = {}
        self.counts: dict[str, int] = {}
        self.known: dict[int, bool] = {}  # token pairs that may stand side by side

    def encode(self, text: bytes) -> list[int]:
        """Plain merging, for short byte strings."""
        out = [self.ids[text[i:i + 1]] for i in range(len(text))]
        while len(out) > 1:
            ranked = [(self.merge[p][0], i) for i, p in enumerate(zip(out, out[1:])) if p in self.merge]
            if not ranked:
                break
            _, i = min(ranked)
            out[i:i + 2] = [self.merge[out[i], out[i + 1]][1]]
        return out

    def edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Tokens that stand at one end (0: left, 1: right) of ``token``
        while it is merged from bytes, each with the rank of the merge that
        ends it."""
        key = token << 1 | side
        found = self.edges.get(key)
        if found is None:
            found, rank = [(token, float("inf"))], None
            while token in self.split:
                rank, halves = self.split[token]
                token = halves[side]
                found.append((token, rank))
            self.edges[key] = found
        return found

    def follows(self, a: int, b: int) -> bool:
        """Whether token b may come after token a (-1: begin a piece): its
        bytes give b alone, and no merge joins the two across the border.
        Of equal merges the leftmost comes first."""
        if b not in self.alone:
            self.alone[b] = self.encode(self.bytes[b]) == [b]
        if a < 0 or not self.alone[b]:
            return self.alone[b]
        for x, x_ends in self.edge(a, 1):
            for y, y_ends in self.edge(b, 0):
                joined = self.merge.get((x, y))
                if joined is not None and joined[0] < x_ends and joined[0] <= y_ends:
                    return False
        return True

    def move(self, state: int, byte: int) -> int:
        """Compile the transition of a long piece's state on a byte."""
        text = self.recent[state] + bytes((byte,))
        shorter, last, total_at, ids, known = self.shorter, self.long_last, self.long_total, self.ids, self.known
        size = len(text)
        prefixes = [state]
        for _ in range(min(size, self.longest) - 1):
            prefixes.append(shorter[prefixes[-1]])
        skip = size - len(prefixes)
        while prefixes:  # the longest token first; only one can follow
            token = ids.get(text[skip:])
            before = prefixes.pop()
            skip += 1
            if token is not None:
                pair = last[before] << 17 | token
                fits = known.get(pair)
                if fits is None:
                    fits = known[pair] = self.follows(last[before], token)
                if fits:
                    break
        else:
            raise ValueError("the vocabulary has no token for a byte")
        total = total_at[before] + 1
        new = len(last)
        if len(text) > self.longest:  # the start of the piece is out of reach: like states are one
            text = text[-self.longest:]
            key, at = [(token, 0)], state
            for _ in range(self.longest - 1):
                key.append((last[at], total_at[at] - total))
                at = self.shorter[at]
            new = self.merged.setdefault(tuple(key), new)
        if new == len(last):
            last.append(token)
            total_at.append(total)
            self.recent.append(text)
            self.shorter.append(state)
        move = self.long_moves[state << 8 | byte] = new << 8 | (total - total_at[state] + 128)
        return move

    def count(self, piece: str) -> int:
        n = self.counts.get(piece)
        if n is None:
            if len(self.last) + len(self.long_last) > self.MOST or len(self.counts) > self.MOST:
                self.clear()
            raw = piece.encode("utf-8")
            n = self.counts[piece] = self._short(raw) if len(raw) <= self.longest else self._long(raw)
        return n

    def _long(self, raw: bytes) -> int:
        n, state, moves = 0, 0, self.long_moves
        for byte in raw:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self.move(state, byte)
            state = move >> 8
            n += (move & 255) - 128
        return n

    def _short(self, raw: bytes) -> int:
        """The same for a piece no longer than a token may be: the states
        passed stay at hand, so transitions are compiled in place."""
        n, state, moves, ids, known, last, total = 0, 0, self.moves, self.ids, self.known, self.last, self.total
        path = [0]
        for i, byte in enumerate(raw):
            at = state << 8 | byte
            move = moves.get(at)
            if move is None:
                for j in range(i + 1):  # the longest token first; only one can follow
                    token = ids.get(raw[j:i + 1])
                    if token is not None:
                        before = path[j]
                        pair = last[before] << 17 | token
                        fits = known.get(pair)
                        if fits is None:
                            fits = known[pair] = self.follows(last[before], token)
                        if fits:
                            break
                else:
                    raise ValueError("the vocabulary has no token for a byte")
                count = total[before] + 1
                move = moves[at] = len(last) << 8 | (count - total[state] + 128)
                last.append(token)
                total.append(count)
            state = move >> 8
            n += (move & 255) - 128
            path.append(state)
        return n


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in the file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Counter:
    """Token counts of texts for a byte-level BPE tokenizer file."""

    BATCH = 1 << 21  # characters processed at once; a longer text alone

    def __init__(self, spec: dict, classes: np.ndarray | None = None) -> None:
        pre = spec.get("pre_tokenizer") or {}
        model = spec["model"]
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or model.get("type") != "BPE":
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.pieces = Pieces(class_table() if classes is None else classes)
        self.tokens = Tokens(model["vocab"], model["merges"])

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        parts: list[str] = []
        owners: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            segments = [text]
            if self.special is not None and self.special.search(text):
                segments = self.special.split(text)
                out[i] += len(segments) - 1
            for s in segments:
                if s:
                    parts.append(s)
                    owners.append(i)
                    size += len(s)
            if size >= self.BATCH:
                self._add(parts, owners, out)
                parts, owners, size = [], [], 0
        self._add(parts, owners, out)
        return out

    def _add(self, parts: list[str], owners: list[int], out: list[int]) -> None:
        if not parts:
            return
        text = "".join(parts)
        ends = np.cumsum([len(p) for p in parts])
        starts = self.pieces.starts(text, np.concatenate([[0], ends[:-1]]))
        stops = np.append(starts[1:], len(text)).tolist()
        known, count = self.tokens.counts, self.tokens.count
        numbers = []
        for a, b in zip(starts.tolist(), stops):
            piece = text[a:b]
            n = known.get(piece)
            if n is None:
                n = count(piece)
                known = self.tokens.counts  # a full table is replaced
            numbers.append(n)
        totals = np.bincount(np.searchsorted(ends, starts, side="right"), weights=numbers, minlength=len(parts))
        for owner, n in zip(owners, totals):
            out[owner] += int(n)


def token_counts(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id") -> DataFrame:
    """key, n_bytes, n_tokens and over_limit of every text; ``path``: the
    tokenizer file, read on the driver and sent to the tasks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    classes = class_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or Counter(spec, classes)
            texts = [t or "" for t in batch.column(0).to_pylist()]
            n_bytes = pa.array([len(t.encode("utf-8")) for t in texts], pa.int64())
            n_tokens = pa.array(counter.counts(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(1), n_bytes, n_tokens], names=["k", "n_bytes", "n_tokens"])

    schema = f"k {docs.schema[key].dataType.simpleString()}, n_bytes bigint, n_tokens bigint"
    out = docs.select(F.col("text").alias("_text"), F.col(key).alias("_key")).mapInArrow(run, schema)
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
