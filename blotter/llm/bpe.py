"""Byte-level BPE as a lazily determinised finite-state transducer.

``Transducer`` reads bytes and emits token ids.  After every byte the prefix
read so far has exactly one encoding, the encoding of a shorter prefix plus
one last token that may stand after that prefix's last token; two tokens may
stand side by side when merging their joined bytes gives the same two back.
A configuration holds, for each place where a longer token may still begin,
the bytes read since and the tokens up to there; tokens that all places agree
on are emitted, so the lookahead is bounded by the longest token.
Configurations become numbered states, and transitions are worked out when a
text first needs them.

Decoding joins the tokens' bytes piece by piece and passes them through
``Utf8Machine``, which carries an unfinished character to the next piece.

Defined cases: a NULL text is the empty text (no ids); repeated rows are each
encoded; unknown ids raise on decoding; bytes that are not UTF-8 decode to
U+FFFD in text and unchanged in bytes.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.native_text import documents
from blotter.llm.shipping import give_back_memory, held_until_needed, on_workers

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bounds of what a worker remembers; results do not depend on them.  A word
#: takes about 200 bytes, a state 210, a move 150 (three for a state at most).
MEMO_WORDS, MEMO_LENGTH, MAX_STATES, MET = 200_000, 48, 100_000, 1 << 21
#: Tokens decoded at a time, and bytes of output per Arrow batch.
DECODE_PIECE, BATCH_BYTES = 65_536, 4 << 20
#: Above any rank.
NEVER = 1 << 62
#: Tokens below a trie node that are looked at one by one.
FEW = 24


@lru_cache(maxsize=1)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token to rank; one per worker process, for both directions."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def by_rank(ranks: dict[bytes, int]) -> list[bytes | None]:
    """The tokens by rank."""
    tokens: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class Trie:
    """The tokens' trie in flat arrays.

    Nodes are numbered breadth first over the sorted tokens, so the children
    of a node are neighbours, ``first[n] .. first[n + 1] - 1``, and the byte
    that leads to a node is ``label[n]``.  The tokens at or below a node are
    neighbours in the sorted order.
    """

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks)
        self.ranks = array("i", [ranks[t] for t in tokens])
        label, first, low, high, token_at = bytearray(1), array("i"), array("i", [0]), array("i", [len(tokens)]), array("i", [-1])
        level, depth = [0], 0
        while level:
            following = []
            for node in level:
                first.append(len(label))
                at, end = low[node], high[node]
                if at < end and len(tokens[at]) == depth:
                    token_at[node] = self.ranks[at]
                    at += 1
                    low[node] = at  # from here on: the tokens below the node
                while at < end:
                    byte, begin = tokens[at][depth], at
                    while at < end and tokens[at][depth] == byte:
                        at += 1
                    following.append(len(label))
                    label.append(byte)
                    low.append(begin)
                    high.append(at)
                    token_at.append(-1)
            level, depth = following, depth + 1
        first.append(len(label))
        self.label, self.first, self.low, self.high, self.token_at = bytes(label), first, low, high, token_at


def merge(ranks: dict[bytes, int], data: bytes) -> list[bytes]:
    """Merge by rank, lowest first and leftmost among equals."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], NEVER))
        joined = parts[best] + parts[best + 1]
        if joined not in ranks:
            break
        parts[best:best + 2] = [joined]
    return parts


class Transducer:
    """Bytes in, token ids out; states and transitions appear on demand.

    Tokens, trie nodes and states are integers; a token's id is its rank.  A
    configuration is kept packed: the last token emitted (-1: none matters),
    then for each place the trie node of the bytes since, the number of tokens
    not yet emitted, and those.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.bytes_of = ranks, by_rank(ranks)
        self.trie = Trie(ranks)
        self.side_by_side: dict[int, bool] = {}
        self.open_after: dict[int, int] = {}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self._reset()

    def _reset(self) -> None:
        start = array("i", (-1, 0, 0)).tobytes()
        self.numbers = {start: 0}
        self.configurations = [start]
        # where a state and a byte lead: a state, or if something is emitted
        # ~k, ``emitting[k]`` being the state and the emitted ids
        self.moves: dict[int, int] = {}
        self.emitting: list[tuple[int, bytes]] = []
        self.ends: list[bytes | None] = [None]

    def _edges(self, token: int) -> tuple[list, list] | None:
        """The pieces that touch the token's left and right end as merging
        goes on, from single byte to whole token; None if merging its bytes
        does not give the token."""
        if token not in self.edges:
            data, found = self.bytes_of[token], None
            if len(data) == 1:
                found = ([token], [token])
            else:
                halves = merge({t: r for t, r in self._within(data) if t != data}, data)
                if len(halves) == 2:
                    left, right = (self._edges(self.ranks[h]) for h in halves)
                    if left and right:
                        found = (left[0] + [token], right[1] + [token])
            self.edges[token] = found
        return self.edges[token]

    def _within(self, data: bytes):
        for i in range(len(data)):
            for j in range(i + 1, len(data) + 1):
                rank = self.ranks.get(data[i:j])
                if rank is not None:
                    yield data[i:j], rank

    def _border_stays(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes keeps the border between them.

        The pieces at the border grow in rank order; the border goes if two
        pieces that touch at some time merge before either grows (leftmost
        first among equal ranks).
        """
        after = self._edges(right)
        if after is None:
            return False
        if left < 0:
            return True
        xs, ys = self._edges(left)[1], after[0]
        i = j = 0
        rank_of, tokens = self.ranks.get, self.bytes_of
        while True:
            grow_x = xs[i + 1] if i + 1 < len(xs) else NEVER
            grow_y = ys[j + 1] if j + 1 < len(ys) else NEVER
            across = rank_of(tokens[xs[i]] + tokens[ys[j]], NEVER)
            if across < grow_x and across <= grow_y and across < NEVER:
                return False
            if grow_x == grow_y == NEVER:
                return True
            if grow_x <= grow_y:
                i += 1
            else:
                j += 1

    def _kept(self, last: int, node: int) -> int:
        """Whether a token below ``node`` may follow ``last``: 0 none may, 1
        some, 2 all.  Where many are below, 1."""
        low, high = self.trie.low[node], self.trie.high[node]
        if high - low > FEW:
            return 1
        key = last << 32 | node
        told = self.open_after.get(key)
        if told is None:
            stay = sum([self._border_stays(last, token) for token in self.trie.ranks[low:high]])
            told = self.open_after[key] = 0 if not stay else 2 if stay == high - low else 1
        return told

    def _move(self, state: int, byte: int) -> tuple[int, bytes]:
        config = array("i", self.configurations[state])
        emitted, at = config[0], 1
        trie, known = self.trie, self.side_by_side
        find, first, token_at = trie.label.find, trie.first, trie.token_at
        after, here = [], None
        while at < len(config):
            node, begin = config[at], at + 2
            at = begin + config[at + 1]
            node = find(byte, first[node], first[node + 1])
            if node < 0:
                continue
            tokens = tuple(config[begin:at])
            last = tokens[-1] if tokens else emitted
            if here is None:
                token = token_at[node]
                if token >= 0:
                    key = last << 32 | token
                    stays = known.get(key)
                    if stays is None:
                        stays = known[key] = self._border_stays(last, token)
                    if stays:
                        here = (*tokens, token)
            if first[node] < first[node + 1] and self._kept(last, node):
                after.append((node, tokens))
        shared = len(here)
        for _, tokens in after:
            agreed = 0
            for a, b in zip(tokens, here):
                if a != b:
                    break
                agreed += 1
            if agreed < shared:
                shared = agreed
                if not shared:
                    break
        if shared:
            emitted = here[shared - 1]
            after = [(node, tokens[shared:]) for node, tokens in after]
        after.append((0, here[shared:]))
        if all(tokens or node and self._kept(emitted, node) == 2 for node, tokens in after):
            emitted = -1  # no place asks what stood before it
        packed = array("i", [emitted])
        for node, tokens in after:
            packed.extend((node, len(tokens), *tokens))
        config = packed.tobytes()
        number = self.numbers.get(config)
        if number is None:
            number = self.numbers[config] = len(self.configurations)
            self.configurations.append(config)
            self.ends.append(None)
        return number, _packed(here[:shared])

    def _end(self, state: int) -> bytes:
        """The ids still to come when the input ends in a state: the tokens of
        its last place, at which a token has just ended."""
        config, at = array("i", self.configurations[state]), 1
        while True:
            begin = at + 2
            at = begin + config[at + 1]
            if at >= len(config):
                return _packed(config[begin:at])

    def encode(self, data: bytes) -> bytes:
        """Ids of one pre-token as little-endian unsigned 32-bit integers."""
        whole = self.ranks.get(data)
        if whole is not None:  # a pre-token that is a token stays whole
            return whole.to_bytes(4, "little")
        if len(self.configurations) > MAX_STATES or len(self.moves) > 3 * MAX_STATES:
            self._reset()
        if len(self.side_by_side) + len(self.open_after) > 3 * MAX_STATES:
            self.side_by_side.clear()
            self.open_after.clear()
        state, out, moves = 0, [], self.moves
        for byte in data:
            move = moves.get(state << 8 | byte)
            if move is None:
                move, emitted = self._move(state, byte)
                if emitted:
                    self.emitting.append((move, emitted))
                    move = -len(self.emitting)
                moves[state << 8 | byte] = move
            if move >= 0:
                state = move
            else:
                state, emitted = self.emitting[~move]
                out.append(emitted)
        end = self.ends[state]
        if end is None:
            end = self.ends[state] = self._end(state)
        out.append(end)
        return b"".join(out)


def _packed(tokens) -> bytes:
    return b"".join([t.to_bytes(4, "little") for t in tokens])


class _Memo(dict):
    """Encodings of recent pre-tokens in two generations.  A pre-token gets in
    when it comes a second time (``met`` tells, by hash): most come once."""

    def __init__(self, transducer: Transducer):
        self.transducer, self.older, self.met = transducer, {}, bytearray(MET)

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.transducer.encode(word.encode("utf-8", "surrogatepass"))
            place = hash(word) % MET
            if not self.met[place]:
                self.met[place] = 1
                return ids
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_WORDS:
                self.older, self.met = dict(self), bytearray(MET)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Encodes whole texts with one rank file and one pattern."""

    def __init__(self, path: str, pattern: str):
        self.split = regex.compile(pattern).findall
        self.memo = _Memo(Transducer(load_ranks(path)))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.split(text)))


class Decoder:
    """Decodes ids with one rank file."""

    def __init__(self, path: str):
        self.bytes_of = by_rank(load_ranks(path))

    def decode(self, ids: bytes) -> Iterator[tuple[bytes, str]]:
        """Pieces of (bytes, text) of little-endian 32-bit ids."""
        machine, numbers = Utf8Machine(), np.frombuffer(ids, "<u4")
        for at in range(0, len(numbers), DECODE_PIECE):
            piece = b"".join(map(self.bytes_of.__getitem__, numbers[at:at + DECODE_PIECE].tolist()))
            yield piece, machine.feed(piece)
        tail = machine.finish()
        if tail:
            yield b"", tail


class Utf8Machine:
    """Incremental UTF-8 decoder.

    The state is the unfinished character: its lead byte decides how many
    continuation bytes are due and which range the first of them may have
    (fixed values of the UTF-8 definition).
    """

    #: lead byte range -> (continuation bytes due, lowest and highest first continuation)
    LEADS = (
        (0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF),
        (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF),
        (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F),
    )

    def __init__(self):
        self.pending = b""

    def _unfinished(self, data: bytes) -> int:
        """Bytes at the end that begin a character whose rest is still due."""
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead < 0x80 or lead >= 0xC0:
                for low, high, due, first, last in self.LEADS:
                    if low <= lead <= high:
                        begun = back == 1 or first <= data[1 - back] <= last
                        return back if back <= due and begun else 0
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.pending + data
        keep = self._unfinished(data)
        self.pending = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.pending = self.pending, b""
        return rest.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process.  It makes many small tuples and no cycles, so
    the collector of cycles is told to look more seldom."""
    give_back_memory()
    gc.set_threshold(200_000, 50, 100)
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


for _cache in (encoder, decoder, load_ranks):
    held_until_needed(_cache.cache_clear)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of about ``BATCH_BYTES`` of ``size(row)``."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row) + 64
        if total >= BATCH_BYTES:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind.type) for column, kind in zip(zip(*rows), schema)], schema=schema)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids``: ids of the whole text as packed little-endian 32-bit."""
    on_workers(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        coder = encoder(path, pattern)
        for batch in batches:
            rows = ((i.as_py(), coder.encode(t.as_py() or "")) for i, t in zip(batch["doc_id"], batch["text"]))
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("ids", pa.binary())])
            yield from in_batches(rows, schema, lambda r: len(r[1]))

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, ids binary")


def _decoded(coder: Decoder, ids: bytes) -> tuple[bytes, int]:
    """Bytes and number of characters of packed ids."""
    pieces, chars = [], 0
    for piece, text in coder.decode(ids):
        pieces.append(piece)
        chars += len(text)
    return b"".join(pieces), chars


def _decoded_schema(batch: pa.RecordBatch, ids: pa.DataType) -> pa.Schema:
    return pa.schema([("doc_id", batch.schema.field("doc_id").type), ("ids", ids),
                      ("decoded", pa.binary()), ("decoded_chars", pa.int64())])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded`` (bytes) and ``decoded_chars``."""
    on_workers(encoded.sparkSession)
    id_type = dict(encoded.dtypes)["doc_id"]

    def run(batches):
        coder = decoder(path)
        for batch in batches:
            rows = ((i.as_py(), ids, *_decoded(coder, ids))
                    for i, ids in ((i, b.as_py() or b"") for i, b in zip(batch["doc_id"], batch["ids"])))
            yield from in_batches(rows, _decoded_schema(batch, pa.binary()), lambda r: len(r[1]) + len(r[2]))

    return encoded.select("doc_id", "ids").mapInArrow(
        run, f"doc_id {id_type}, ids binary, decoded binary, decoded_chars bigint")


def encode_decode(docs: DataFrame, path: str, pattern: str, lists: bool = False) -> DataFrame:
    """``decode(encode(docs))`` with one worker per task doing both, so that
    a node holds the tables of as many workers as it has cores.  ``lists``:
    ids as an array of integers instead of packed."""
    on_workers(docs.sparkSession)
    id_type = dict(docs.dtypes)["doc_id"]
    shape = (lambda ids: np.frombuffer(ids, "<i4")) if lists else bytes
    kind = pa.list_(pa.int32()) if lists else pa.binary()

    def run(batches):
        there, back = encoder(path, pattern), decoder(path)
        for batch in batches:
            rows = ((i.as_py(), shape(ids), *_decoded(back, ids))
                    for i, ids in ((i, there.encode(t.as_py() or "")) for i, t in zip(batch["doc_id"], batch["text"])))
            yield from in_batches(rows, _decoded_schema(batch, kind), lambda r: 4 * len(r[1]) + len(r[2]))

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, ids {'array<int>' if lists else 'binary'}, decoded binary, decoded_chars bigint")


def digests() -> list[Column]:
    """Count and digests of the ids and the decoded bytes of a round trip."""
    return [F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256")]


def with_vocabulary() -> tuple[str, str]:
    """Path and pattern of the registered vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def round_trip(docs: DataFrame, lists: bool = False) -> DataFrame:
    """``doc_id, ids, decoded, decoded_chars`` with the registered vocabulary."""
    return encode_decode(docs, *with_vocabulary(), lists)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir)).select("doc_id", *digests(), "decoded_chars")
