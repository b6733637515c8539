"""Byte-level BPE: merges compiled into a lazily determinised transducer, and streaming decoding."""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from caskline.llm.common import slices

#: Text bytes handled at a time inside a task, and ids decoded at a time.
PIECE, CHUNK = 1 << 20, 1 << 16
#: Arcs of the transducer, and whole pieces of a generation, that a worker remembers.
ARCS, KNOWN = 400_000, 100_000
#: Bytes that a piece's first arc reads at once.
HEAD = 5
_NEVER = 1 << 62
_BYTES = [bytes((b,)) for b in range(256)]


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base 64 and its rank, which is its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merged(piece: bytes, ranks: Mapping[bytes, int], stop: int = 1) -> tuple[list[bytes], list[int]]:
    """The definition: join the neighbours whose union ranks lowest, leftmost first, while there are any
    and more than ``stop`` parts. Returns the parts and the ranks of the joins in the order made."""
    parts, made = [piece[k : k + 1] for k in range(len(piece))], []
    while len(parts) > stop:
        rank, at = min((ranks.get(parts[k] + parts[k + 1], _NEVER), k) for k in range(len(parts) - 1))
        if rank == _NEVER:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        made.append(rank)
    return parts, made


class Transducer:
    """Reads bytes, writes token ids; states and arcs are made when first needed.

    The tokens of every prefix of a piece are those of a shorter prefix and one more, and two tokens may
    stand side by side if no merge would have crossed from one to the other. So a state is a list of
    branches, one for each earlier position that a later token can still start from: the bytes read since
    (the beginning of some token), what the token before allows to follow, and the ids not written yet.
    A byte lengthens all branches; the one that completes an allowed token opens the branch of the new
    position. Ids that all branches share are certain and are written, so nothing is held for longer
    than tokens can be undecided.

    This needs tokens that their own merges make, in growing order of rank. A token that its merges don't
    make is written for a piece equal to it only; with any other vocabulary ``check`` raises.
    """

    def __init__(self, ranks: Mapping[bytes, int], unmade: Iterable[bytes] = (), arcs: int = ARCS):
        self.ranks, self.unmade, self.limit = ranks, set(unmade), arcs
        #: The ranks of the tokens that begin with some bytes, in order.
        self.longer: dict[bytes, list[int]] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            for k in range(1, len(token)):
                self.longer.setdefault(token[:k], []).append(rank)
        #: All tokens and their beginnings: the rank, or -1 for what is no token itself.
        self.reads: dict[bytes, int] = dict.fromkeys(self.longer, -1) | dict(ranks)
        self.spines: dict[bytes, tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]] = {}
        self.befores: dict[tuple[tuple[bytes, int], ...], int] = {(): 0}
        self.ends_of: list[list[tuple[bytes, int]]] = [[]]
        self.before_of: dict[bytes, int] = {}
        self.allowed: dict[int, bool] = {}
        #: Two generations of arcs and states: when the younger one is full it becomes the older, whose place it
        #: takes, and what is met again is taken over. Numbers of states are never given twice.
        self.arcs: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.states: dict[int, tuple[tuple[bytes, int, tuple[int, ...]], ...]] = {}
        self.numbers: dict[tuple[tuple[bytes, int, tuple[int, ...]], ...], int] = {}
        self.made = 1
        self._age()

    def check(self) -> Transducer:
        """Test every token; note those that can only be whole pieces."""
        for token, rank in self.ranks.items():
            parts, made = merged(token, self.ranks)
            if len(parts) > 1:
                self.unmade.add(token)
            elif made != sorted(made) or made and made[-1] != rank:
                raise ValueError(f"the merges of token {rank} don't come in order")
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"no token for the bytes {missing}")
        return self

    def _age(self) -> None:
        self.older_arcs, self.older_states, self.older_numbers = self.arcs, self.states, self.numbers
        start = ((b"", 0, ()),)
        self.arcs, self.states, self.numbers = {}, {0: start}, {start: 0}
        #: Where the first bytes of a piece lead, and what they write: arcs of several bytes.
        self.heads: dict[bytes, tuple[int, tuple[int, ...]]] = {}

    def _spines(self, token: bytes) -> tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]]:
        """The token's first and its last part at every time of its making, each with the rank that ends it."""
        got = self.spines.get(token)
        if got is None:
            first, last = [], []
            if len(token) > 1:
                (left, right), _ = merged(token, self.ranks, 2)
                rank = self.ranks[token]
                first = [*self._spines(left)[0][:-1], (left, rank)]
                last = [*self._spines(right)[1][:-1], (right, rank)]
            got = self.spines[token] = ([*first, (token, _NEVER)], [*last, (token, _NEVER)])
        return got

    def _before(self, token: bytes) -> int:
        """A number for what may follow a token: tokens whose ends meet the same merges share it."""
        number = self.before_of.get(token)
        if number is None:
            ends = [(x, until) for x, until in self._spines(token)[1] if x in self.longer and self.longer[x][0] < until]
            key = tuple((x, bisect_left(self.longer[x], until)) for x, until in ends)
            number = self.befores.setdefault(key, len(self.ends_of))
            if number == len(self.ends_of):
                self.ends_of.append(ends)
            self.before_of[token] = number
        return number

    def _may_follow(self, before: int, token: bytes, rank: int) -> bool:
        """Whether no merge crosses from the token before to this one while both are made."""
        got = self.allowed.get(before << 32 | rank)
        if got is None:
            if len(self.allowed) * 2 >= self.limit:
                self.allowed.clear()
            got = self.allowed[before << 32 | rank] = not self._crossed(before, token)
        return got

    def _crossed(self, before: int, token: bytes) -> bool:
        rank = self.ranks.get
        for x, until in self.ends_of[before]:
            for y, till in self._spines(token)[0]:
                # Of equal merges the leftmost comes first: that inside the left token, then this one, then
                # that inside the right token.
                if (r := rank(x + y)) is not None and r < until and r <= till:
                    return True
        return False

    def _state(self, branches: tuple[tuple[bytes, int, tuple[int, ...]], ...]) -> int:
        number = self.numbers.get(branches)
        if number is None:
            number = self.older_numbers.get(branches)
            if number is None:
                number, self.made = self.made, self.made + 1
            self._keep(number, branches)
        return number

    def _keep(self, number: int, branches: tuple[tuple[bytes, int, tuple[int, ...]], ...]) -> None:
        self.states[number] = branches
        self.numbers[branches] = number

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        branches = self.states[state]
        if len(self.arcs) * 2 >= self.limit:
            self._age()
            self._keep(state, branches)
        known = self.older_arcs.get(state << 8 | byte)
        if known is not None:
            if known[0] not in self.states:
                self._keep(known[0], self.older_states[known[0]])
            self.arcs[state << 8 | byte] = known
            return known
        more, kept, opened = _BYTES[byte], [], None
        reads, longer = self.reads, self.longer
        for read, before, ids in branches:  # the longest first
            token = read + more
            rank = reads.get(token)
            if rank is None:
                continue
            if opened is None:
                # Number 0 is for tokens that any other may follow.
                if rank >= 0 and token not in self.unmade and (not before or self._may_follow(before, token, rank)):
                    opened = (b"", self._before(token), (*ids, rank))
            if token in longer:
                kept.append((token, before, ids))
        if opened is None:
            raise ValueError("a byte without a token")
        kept.append(opened)
        written = kept[0][2]
        if written:
            for _, _, ids in kept:
                while written != ids[: len(written)]:
                    written = written[:-1]
            if cut := len(written):
                kept = [(read, before, ids[cut:]) for read, before, ids in kept]
        arc = self.arcs[state << 8 | byte] = self._state(tuple(kept)), written
        return arc

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.unmade:
            return [self.ranks[piece]]
        head = piece[:HEAD]
        got = self.heads.get(head)
        if got is None:
            state, written = self._walk(0, head)
            if len(self.heads) >= self.limit:
                self.heads.clear()
            # If the walk has opened a generation, its last state is of that, as the table is.
            got = self.heads[head] = state, tuple(written)
        out = list(got[1])
        state, written = self._walk(got[0], piece[HEAD:])
        out += written
        out += self.states[state][-1][2]
        return out

    def _walk(self, state: int, read: bytes) -> tuple[int, list[int]]:
        out: list[int] = []
        arcs = self.arcs
        for byte in read:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                arc = self._arc(state, byte)
                arcs = self.arcs
            state, written = arc
            if written:
                out += written
        return state, out


class _Known(dict):
    """Ids of pieces, as bytes of little-endian 32-bit integers; a piece that is missing is learnt.

    There are two generations: when the younger one is full it becomes the older, whose place it
    takes, so a piece that keeps coming stays known.
    """

    def __init__(self, transducer: Transducer):
        self.encode = transducer.encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("I", self.encode(piece.encode())).tobytes()
        if len(piece) < 64:
            self[piece] = ids
        return ids

    def age(self) -> None:
        self.older = dict(self)
        self.clear()


class Encoder:
    """A pattern's pieces of a text through the transducer; frequent pieces are remembered whole."""

    def __init__(self, transducer: Transducer, pattern: str, known: int = KNOWN):
        self.pattern, self.limit = regex.compile(pattern), known
        self.known = _Known(transducer)

    def packed(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if len(text) <= PIECE:
            pieces: Iterable[str] = self.pattern.findall(text)
        else:
            pieces = (match.group() for match in self.pattern.finditer(text))
        out = b"".join(map(self.known.__getitem__, pieces))
        if len(self.known) >= self.limit:
            self.known.age()
        return out

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()


def _utf8_machine() -> dict[tuple[int, int], int]:
    """(state, byte) -> state. State 0 stands between characters, 1 to 3 wait for as many bytes more;
    4 to 7 wait for a second byte that shortest forms, surrogates and the last code point restrict."""
    span = lambda state, low, high, to: {(state, b): to for b in range(low, high + 1)}
    return {
        **span(0, 0x00, 0x7F, 0), **span(0, 0xC2, 0xDF, 1), **span(0, 0xE1, 0xEC, 2), **span(0, 0xEE, 0xEF, 2),
        **span(0, 0xF1, 0xF3, 3), (0, 0xE0): 4, (0, 0xED): 5, (0, 0xF0): 6, (0, 0xF4): 7,
        **span(1, 0x80, 0xBF, 0), **span(2, 0x80, 0xBF, 1), **span(3, 0x80, 0xBF, 2),
        **span(4, 0xA0, 0xBF, 1), **span(5, 0x80, 0x9F, 1), **span(6, 0x90, 0xBF, 2), **span(7, 0x80, 0x8F, 2),
    }


class Utf8Stream:
    """Turns chunks of bytes into text. A character that a chunk ends within waits for the next chunk; bytes
    that are part of no character become U+FFFD, as many as when all bytes come at once."""

    machine = _utf8_machine()

    def __init__(self) -> None:
        self.held = b""

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        cut = len(data)
        for start in range(len(data) - 1, max(-1, len(data) - 4), -1):
            if data[start] & 0xC0 != 0x80:  # the last byte that isn't a following one
                state = 0
                for byte in data[start:]:
                    state = self.machine.get((state, byte), -1)
                if state > 0:
                    cut = start
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class TokenBytes:
    """The bytes of many ids at once, from one array of all tokens."""

    def __init__(self, tokens: Mapping[int, bytes]):
        self.ids = np.array(sorted(tokens), np.int64)
        parts = [tokens[i] for i in self.ids.tolist()]
        self.size = np.array([len(x) for x in parts], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def of(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes, and where those of each id begin, with the end of all."""
        place = np.searchsorted(self.ids, ids) if len(self.ids) and self.ids[-1] >= len(self.ids) else ids
        odd = (place < 0) | (place >= len(self.ids))
        odd[~odd] = self.ids[place[~odd]] != ids[~odd]
        if odd.any():
            raise KeyError(int(ids[odd][0]))
        size = self.size[place]
        bounds = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.begin[place] - bounds[:-1], size) + np.arange(bounds[-1])
        return self.data[at].tobytes(), bounds

    def texts(self, column: pa.ListArray, chunk: int = CHUNK) -> list[str]:
        """The text of each row's ids: rows of up to ``chunk`` ids are taken together, longer ones in parts."""
        sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        ids, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes, dtype=np.int64)
        texts: list[str] = []
        while (row := len(texts)) < len(ends):
            start = int(ends[row] - sizes[row])
            stop = max(int(np.searchsorted(ends, start + chunk, side="right")), row + 1)
            if sizes[row] <= chunk:
                data, bounds = self.of(ids[start : ends[stop - 1]])
                cuts = [0, *bounds[ends[row:stop] - start].tolist()]
                for begin, end in zip(cuts, cuts[1:], strict=False):
                    stream = Utf8Stream()
                    texts.append(stream.feed(data[begin:end]) + stream.end())
            else:
                stream = Utf8Stream()
                parts = [stream.feed(self.of(ids[at : min(at + chunk, ends[row])])[0]) for at in range(start, ends[row], chunk)]
                texts.append("".join([*parts, stream.end()]))
        return texts


_HERE: dict[tuple[str, str], Encoder] = {}


def _worker_encoder(name: str, ranks: Broadcast, unmade: frozenset[bytes], pattern: str) -> Encoder:
    """One encoder for each vocabulary and worker: later tasks go on with the states made so far."""
    key = (name, pattern)
    if key not in _HERE:
        _HERE.clear()
        _HERE[key] = Encoder(Transducer(ranks.value, unmade), pattern)
    return _HERE[key]


def encode_texts(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text; each match of ``pattern`` is a piece of its own.

    Returns id, ids (array), n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers).
    Null and empty texts have no ids. Rows are encoded one by one and none is moved, so repeated rows and
    ids, null ids and a source with a third of all rows cost what other rows cost. Columns other than id
    and text aren't read, so their names can't clash. A text's ids stand in memory beside it (4 bytes
    each and a list), also those of a very long one; its pieces are read one after the other. The
    vocabulary is sent to the tasks: its size is that of the rank file.
    """
    return _encoded(docs, ranks, pattern, id_col, text_col).withColumnRenamed("_id", id_col)


def _encoded(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, id_col: str, text_col: str) -> DataFrame:
    checked = Transducer(ranks).check()
    sent, unmade = docs.sparkSession.sparkContext.broadcast(dict(ranks)), frozenset(checked.unmade)
    name = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collecting = gc.isenabled()
        gc.disable()  # states and arcs make no circles, and there are many to look through
        try:
            yield from encode(batches)
        finally:
            if collecting:
                gc.enable()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(name, sent, unmade, pattern)
        for batch in slices(batches, "_text", PIECE):
            found = [encoder.packed(text or "") for text in batch.column("_text").to_pylist()]
            sizes = np.array([len(ids) // 4 for ids in found])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4"))),
                    pa.array(sizes, pa.int64()),
                    pa.array([hashlib.sha256(ids).hexdigest() for ids in found], pa.string()),
                ],
                names=["_id", "ids", "n_tokens", "ids_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, ids array<int>, n_tokens bigint, ids_sha256 string")


def decode_ids(encoded: DataFrame, ranks: Mapping[bytes, int], ids_col: str = "ids", name: str = "text") -> DataFrame:
    """Replace the column of ids by the text that they stand for; all other columns stay.

    Ids are decoded in chunks through an incremental UTF-8 machine, so a character may begin in one token
    (or chunk) and end in another. Bytes that make no character become U+FFFD; an id without a token
    raises. Null and empty arrays give an empty text.
    """
    sent = encoded.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    kept = [column for column in encoded.columns if column not in (ids_col, name)]
    schema = encoded.select(*kept).schema.add(name, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenBytes(sent.value)
        for batch in batches:
            texts = tokens.texts(batch.column(ids_col))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, name])

    return encoded.select(*kept, ids_col).mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks: Mapping[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode, and digest both: id, n_tokens, ids_sha256, decoded_sha256 (of the decoded bytes)."""
    decoded = decode_ids(_encoded(docs, ranks, pattern, id_col, text_col), ranks, name="_decoded")
    return decoded.select(F.col("_id").alias(id_col), "n_tokens", "ids_sha256", F.sha2(F.col("_decoded").cast("binary"), 256).alias("decoded_sha256"))
