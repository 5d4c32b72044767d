"""Token counts by a finite-state transducer compiled from a piece vocabulary; the tokenizer itself is never run.

**Compilation.** A byte-pair encoding is right if each two neighbouring tokens are what their joined text encodes to. So the
last token of a text that grows by a character is the one piece that ends there and may follow the last token of the text
before it. A state keeps just what later characters can ask for: of each position from which the text since is the beginning
of a longer piece, the last token there and how many tokens fewer there were. With finitely many pieces these are finitely
many states. A transition is annotated with the tokens it adds (a longer piece that swallows others adds a negative number),
so the sum along a text is its token count. States and transitions are compiled when a text first needs them.

**Chunks.** A slice of texts is cut behind spaces and behind characters without a piece. A chunk does not know the state it
is entered in; it is one of the few that spaces lead to, so its result is a map from each of these to the state at its end
and the tokens added. Up to the first word border the chunk runs once for each entry state, from there on they are one. All
chunks of a slice run side by side in numpy, and a parallel prefix scan composes their maps; where a text begins, the entry
state is known and its map constant, so differences of the scan are the texts' counts. Longer texts are several slices: the
state goes on from one to the next.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewpulse.llm.shipping import in_arrow

#: Code points of a slice and, about, of a chunk.
SLICE, CHUNK = 2 << 20, 1024
#: States kept by a worker; beyond, compilation starts anew with the next slice.
MOST_STATES = 400_000
#: Chunks left at which numpy does not pay any more.
FEW = 12
SPACE = "▁"
LIMIT = 4096


class Moves:
    """Transitions in numpy arrays: a hash table from state and symbol to the state behind and the tokens added."""

    EMPTY = -1
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, bits: int = 16):
        self.bits, self.n = bits, 0
        self.keys, self.values = np.full(1 << bits, self.EMPTY, np.int64), np.zeros(1 << bits, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and the places of keys that are not in the table."""
        slots = self._slots(keys)
        held = self.keys[slots]
        values = self.values[slots]
        rest = np.flatnonzero(held != keys)
        lost = []
        slots, held = slots[rest], held[rest]
        while len(rest):
            void = held == self.EMPTY
            lost.append(rest[void])
            rest, slots = rest[~void], (slots[~void] + 1) & (len(self.keys) - 1)
            held = self.keys[slots]
            hit = held == keys[rest]
            values[rest[hit]] = self.values[slots[hit]]
            rest, slots, held = rest[~hit], slots[~hit], held[~hit]
        return values, np.concatenate(lost) if lost else rest

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Put distinct new keys into the table."""
        if 2 * (self.n + len(keys)) > len(self.keys):
            old = self.keys != self.EMPTY
            keys, values = np.concatenate((self.keys[old], keys)), np.concatenate((self.values[old], values))
            self.bits = max(self.bits + 1, (4 * len(keys) - 1).bit_length())
            self.keys, self.values = np.full(1 << self.bits, self.EMPTY, np.int64), np.zeros(1 << self.bits, np.int64)
            self.n = 0
        self.n += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == self.EMPTY
            self.keys[slots[free]] = keys[free]
            won = self.keys[slots] == keys
            self.values[slots[won]] = values[won]
            keys, values, slots = keys[~won], values[~won], (slots[~won] + 1) & (len(self.keys) - 1)


class Transducer:
    """Counts the tokens of a sentencepiece BPE model with byte fallback, a leading space and no other normalisation."""

    #: Transition values hold the state behind and the tokens added, which are over -WIDTH / 2.
    WIDTH = 128

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in normal}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.scores):
            raise ValueError("pieces with a space inside or behind are not supported")
        self.prefixes = {piece[:n] for piece in self.scores for n in range(1, len(piece))}
        self.alphabet = sorted({c for piece in self.scores for c in piece} | {SPACE})
        # Behind the alphabet come four symbols for the characters without a piece, by the bytes that stand for them.
        n = len(self.alphabet)
        self.width = n + 5
        self.symbols = np.full(0x110000, n + 4, np.int32)
        for size, end in ((3, 0x10000), (2, 0x800), (1, 0x80)):
            self.symbols[:end] = n + size
        self.symbols[[ord(c) for c in self.alphabet]] = np.arange(n)
        self.space = self.alphabet.index(SPACE)
        self.symbols[ord(" ")] = self.space
        self._begin()

    def _begin(self) -> None:
        self.moves, self.states, self.number = Moves(), [], {}
        self.allowed: dict[tuple[str, str], bool] = {}
        self.single: dict[int, int] = {}
        self.reset = self._state([("", "", 0)])
        # The states that spaces lead to, however many there are.
        self.borders, at = [], self.reset
        while at not in self.borders:
            self.borders.append(at)
            at = self._move(at * self.width + self.space) // self.WIDTH
        self.border_of = {s: k for k, s in enumerate(self.borders)}
        self.start = self.borders[1]

    def _state(self, anchors: list[tuple[str, str, int]]) -> int:
        """Number of a state. Anchors: text since a position, the last token there ("" before any) and its tokens against now."""
        key = "\n".join(f"{text}\t{last}\t{tokens}" for text, last, tokens in anchors)
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short text: the pair of the best score first, then the leftmost."""
        parts = list(text)
        while True:
            pairs = [(-self.scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.scores]
            if not pairs:
                return parts
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _follows(self, last: str, piece: str) -> bool:
        """Whether `piece` can be the token after `last`."""
        known = self.allowed.get((last, piece))
        if known is None:
            known = self.allowed[last, piece] = self._merged(last + piece) == [*([last] if last else []), piece]
        return known

    def _move(self, key: int) -> int:
        """The transition of `key`: state times width plus symbol."""
        state, symbol = divmod(key, self.width)
        half = self.WIDTH // 2
        if symbol >= len(self.alphabet):
            return self.reset * self.WIDTH + symbol - len(self.alphabet) + half
        c = self.alphabet[symbol]
        longer, piece, added = [], None, 0
        for line in self.states[state].split("\n"):
            text, last, tokens = line.split("\t")
            grown = text + c
            if piece is None and grown in self.scores and self._follows(last, grown):
                piece, added = grown, int(tokens) + 1
            if grown in self.prefixes:
                # No piece goes on over a space, so what stood before it makes no difference.
                longer.append((grown, "" if c == SPACE and not text and not last.endswith(SPACE) else last, int(tokens)))
        anchors = [(text, last, tokens - added) for text, last, tokens in longer]
        return self._state([*anchors, ("", piece, 0)]) * self.WIDTH + added + half

    def _step(self, keys: np.ndarray) -> np.ndarray:
        values, lost = self.moves.find(keys)
        if len(lost):
            new, back = np.unique(keys[lost], return_inverse=True)
            made = np.fromiter(map(self._move, new.tolist()), np.int64, len(new))
            self.moves.add(new, made)
            values[lost] = made[back]
        return values

    def _one(self, state: int, symbols: Sequence[int]) -> tuple[int, int]:
        single, width, total = self.single, self.width, 0
        for s in symbols:
            key = state * width + s
            value = single.get(key)
            if value is None:
                value = single[key] = int(self._step(np.array([key]))[0])
            state, added = divmod(value, self.WIDTH)
            total += added
        return state, total - self.WIDTH // 2 * len(symbols)

    def advance(self, text: np.ndarray, states: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run each range of `text` (symbols) from its state: the states behind, and the tokens added."""
        order = np.argsort(begins - ends, kind="stable")
        at, sizes = begins[order], (ends - begins)[order]
        now, added = states[order].astype(np.int64), np.zeros(len(order), np.int64)
        # How many ranges are longer than each number of steps, while they are many.
        longest = int(sizes[0]) if len(sizes) else 0
        active = np.searchsorted(-sizes, -np.arange(longest), side="left")
        for step in range(longest):
            n = int(active[step])
            if n <= FEW:
                for i in range(n):
                    now[i], more = self._one(int(now[i]), text[at[i] + step : at[i] + sizes[i]].tolist())
                    added[i] += more
                break
            values = self._step(now[:n] * self.width + text[at[:n] + step])
            now[:n] = values // self.WIDTH
            added[:n] += values % self.WIDTH - self.WIDTH // 2
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return now[back], added[back]

    def chunk_maps(self, text: np.ndarray, starts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Chunks of `text`: where they begin, their maps (border at the end and tokens added, for each border at entry), and
        the state behind. `starts` begins with 0; there a chunk begins and is entered in a known state, so its map is constant."""
        n = len(text)
        bare = text >= len(self.alphabet)
        border = bare | (text == self.space)
        cuts = np.flatnonzero(border) + 1
        wanted = np.searchsorted(cuts, np.arange(CHUNK, n, CHUNK))
        begins = np.unique(np.concatenate((starts, cuts[wanted[wanted < len(cuts)]])))
        begins = begins[begins < n]
        ends = np.append(begins[1:], n)
        known = np.isin(begins, starts)
        # A word border tells where all entries lead to the same state: a space behind a letter, or no piece at all.
        same = bare.copy()
        same[1:] |= border[1:] & ~border[:-1]
        same = np.append(np.flatnonzero(same) + 1, n)
        heads = np.where(known, begins, np.minimum(same[np.searchsorted(same, begins + 1)], ends))
        k = len(self.borders)
        open_ = np.flatnonzero(~known)
        state, tokens = self.advance(text, np.tile(self.borders, len(open_)), np.repeat(begins[open_], k), np.repeat(heads[open_], k))
        state, tokens = state.reshape(-1, k), tokens.reshape(-1, k)
        at = np.empty((len(begins), k), np.int64)
        added = np.zeros((len(begins), k), np.int64)
        at[open_], added[open_] = state, tokens
        at[known] = entries[:, None]
        # Behind the head one run serves all entries; a chunk without a border inside has only its head.
        go = np.flatnonzero(heads < ends)
        state, tokens = self.advance(text, at[go, 0], heads[go], ends[go])
        at[go] = state[:, None]
        added[go] += tokens[:, None]
        place = np.zeros(len(self.states), np.int64)
        place[self.borders] = np.arange(k)
        return begins, place[at], added, at

    def _slice(self, text: np.ndarray, starts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, int]:
        """Tokens added by each text of a slice, and the state at its end."""
        begins, at, added, states = self.chunk_maps(text, starts, entries)
        total, place = scan(at, added)
        ends = np.append(np.searchsorted(begins, starts)[1:], len(begins)) - 1
        # The first map is constant, so any entry will do; the last chunk is entered where those before it end.
        entry = place[-2, 0] if len(begins) > 1 else 0
        return np.diff(total[ends, 0], prepend=0), int(states[-1, entry])

    def _symbols(self, text: str) -> np.ndarray:
        return self.symbols[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def counts(self, texts: Iterable[str | None]) -> Iterator[int]:
        """Number of tokens of each text; null and empty texts have none."""
        part: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if len(text) > SLICE:
                yield from self._many(part)
                part, size = [], 0
                yield self._long(text)
                continue
            part.append(text)
            size += len(text)
            if size >= SLICE:
                yield from self._many(part)
                part, size = [], 0
        yield from self._many(part)

    def _many(self, texts: list[str]) -> list[int]:
        self._tidy()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        full = sizes > 0
        out = np.zeros(len(texts), np.int64)
        if full.any():
            starts = (np.cumsum(sizes) - sizes)[full]
            # The space that goes before a text is read already: one token.
            out[full] = self._slice(self._symbols("".join(texts)), starts, np.full(len(starts), self.start))[0] + 1
        return out.tolist()

    def _long(self, text: str) -> int:
        self._tidy()
        state, total = self.start, 1
        for at in range(0, len(text), SLICE):
            added, state = self._slice(self._symbols(text[at : at + SLICE]), np.zeros(1, np.int64), np.array([state]))
            total += int(added[0])
        return total

    def _tidy(self) -> None:
        if len(self.states) > MOST_STATES:
            self._begin()


def scan(at: np.ndarray, added: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parallel prefix scan: the maps of chunks 0..i composed, for each i, in as many rounds as the number of chunks has bits."""
    at, added = at.copy(), added.copy()
    d = 1
    while d < len(at):
        # The map of the d chunks up to here, entered where those before it end.
        total = added[:-d] + np.take_along_axis(added[d:], at[:-d], 1)
        place = np.take_along_axis(at[d:], at[:-d], 1)
        added[d:], at[d:] = total, place
        d *= 2
    return added, at


@cache
def transducer(path: str) -> Transducer:
    """One per worker process."""
    return Transducer(path)


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = transducer(path).counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > `limit`) of every document, for the model file at `path`.

    The file has to be readable at the same place on every worker. A null or empty text has no bytes and no tokens. Strings
    that look like special tokens are plain text. Rows without `doc_id` and repeated rows each get their row; other columns
    are ignored; an empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text")
    counted = in_arrow(rows, _count(path), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
