"""Byte-level BPE as a lazily determinised transducer, and its streaming decoder.

Encoding. Two tokens are *compatible* when merging their joined bytes by rank
gives exactly these two tokens back. A token sequence is the BPE encoding of its
bytes if and only if all neighbours are compatible, and each prefix of a piece
has exactly one such encoding. So a piece can be read left to right by a
non-deterministic machine whose items are (trie node of the unfinished token,
last finished token): an item advances through the trie of the vocabulary, and
when it reaches a token compatible with its last one, a new item starts at the
root. The subset construction is done on demand: a state is the set of live
items, and a transition tells the token that ends the encoding of the bytes so
far. Tokens are emitted once all live items agree on them. An item dies as soon
as its bytes are no prefix of any token, so that waits for a bounded number of
bytes (a small multiple of the longest token). States,
transitions, the compatibility of pairs and the pieces met are kept in bounded tables
from task to task of a worker, emptied when full and rebuilt on demand.

A piece is one match of the splitting pattern; a piece that is itself a token is
that token. The merges compare ranks of joined bytes, leftmost first on ties.

Decoding. Token bytes run through an incremental UTF-8 machine whose state is
the unfinished bytes of one character (at most three), so ids can be fed one by
one. Its transitions are lifted from bytes to tokens and kept. Ill-formed bytes
become U+FFFD, one for each maximal ill-formed part.

Defined results: NULL and empty texts encode to no ids and decode to the empty
text; ids outside the vocabulary raise; repeated rows are encoded one by one;
an empty table gives an empty result; other columns pass through
:func:`encode_documents` and are ignored by the contract query.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.common import empty_worker, kept_in_worker, map_batches, table

PIECES_KEPT = 150_000   # encoded pieces in each of the two generations that a worker remembers
PIECE_BYTES = 64        # longer pieces are not remembered
LOOKAHEAD = 1 << 10     # bytes of a piece held before agreed tokens are emitted
STATES_KEPT = 150_000   # determinised states
PAIRS_KEPT = 300_000    # compatibility results, kept from task to task
FRESH = ()              # decoder state between characters


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_bytes(ranks: dict[bytes, int], data: bytes, least: int = 1) -> list[int]:
    """BPE by its definition: join the neighbours of lowest joined rank, leftmost first, until none (or ``least``) is left."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > least:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Encoder:
    """The lazily determinised transducer of one vocabulary.

    Trie nodes, items and states are numbers, so the tables are plain dictionaries from
    number to number. The lowest ``shift`` bits of an item are its last token plus one, the
    others its node; a state is numbered in steps of 256, so that a state plus a byte is a transition.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.ids = list(range(max(self.bytes_of) + 1))  # one object a token, side by side in memory
        self.size = [len(self.bytes_of.get(i, b"")) for i in self.ids]
        self.shift = len(self.ids).bit_length()
        numbers: dict[bytes, int] = {b"": 0}    # trie nodes that have children
        self.depth = [0]
        for data in ranks:
            for end in range(1, len(data)):
                if data[:end] not in numbers:
                    numbers[data[:end]] = len(numbers)
                    self.depth.append(end)
        # node * 256 + byte to the node there (0 without children), shifted, plus the token that ends there plus one
        self.children: dict[int, int] = {}
        for data in {**numbers, **ranks}:
            if data:
                self.children[numbers[data[:-1]] << 8 | data[-1]] = (
                    numbers.get(data, 0) << self.shift | ranks.get(data, -1) + 1)
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self._reset()

    def _reset(self) -> None:
        self.states: dict[tuple[int, ...], int] = {}    # items to state
        self.items: list[tuple[int, ...]] = []
        self.ended: list[int] = []      # the token that ends the encoding of the bytes up to a state
        self.next: dict[int, int] = {}
        self.start = self._state((0,), -1)

    def _state(self, items: tuple[int, ...], ended: int) -> int:
        state = self.states.get(items)
        if state is None:
            state = self.states[items] = len(self.items) << 8
            self.items.append(items)
            self.ended.append(ended)
        return state

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens that ``token`` is merged from at last, if all merges on the way come in the order of their
        ranks; (-1, -1) for a single byte, None for any other token."""
        if token not in self.splits:
            data, found = self.bytes_of[token], None
            if len(data) == 1:
                found = (-1, -1)
            else:
                parts = merge_bytes(self.ranks, data, 2)
                if len(parts) == 2 and all(self._split(p) and (p < token or len(self.bytes_of[p]) == 1) for p in parts):
                    found = (parts[0], parts[1])
            self.splits[token] = found
        return self.splits[token]

    def _part(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border of two tokens, their last merges undone one by one, latest first.

        Before a merge is done, the border's neighbours are those left when it is undone; they would
        have been merged instead if their rank is lower (or equal, and they are further left).
        """
        bytes_of, splits, rank_of = self.bytes_of, self.splits, self.ranks.get
        limit = 1 << self.shift
        while True:
            joined = rank_of(bytes_of[left] + bytes_of[right])
            if joined is not None and joined < limit:
                return False
            last, first = splits[left][1], splits[right][0]
            if last >= 0 and (first < 0 or left > right):
                limit, left = left, last
            elif first >= 0:
                limit, right = right + 1, first
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``; for left = -1, whether ``right`` encodes to itself."""
        key = left + 1 << self.shift | right
        answer = self.pairs.get(key)
        if answer is None:
            if left < 0:
                answer = bool(self._split(right)) or merge_bytes(self.ranks, self.bytes_of[right]) == [right]
            elif self._split(left) and self._split(right):
                answer = self._part(left, right)
            else:
                answer = merge_bytes(self.ranks, self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            self.pairs[key] = answer
        return answer

    def _end(self, state: int, byte: int) -> int:
        """The token that ends the encoding after a byte, or -1; at most one live item has it."""
        shift, tokens, children, pairs = self.shift, (1 << self.shift) - 1, self.children.get, self.pairs.get
        for item in self.items[state >> 8]:
            token = (children(item >> shift << 8 | byte, 0) & tokens) - 1
            if token >= 0:
                last = item & tokens
                fits = pairs(last << shift | token)
                if self.compatible(last - 1, token) if fits is None else fits:
                    return self.ids[token]
        return -1

    def _step(self, state: int, byte: int) -> int:
        """The state after a byte; built once per state and byte."""
        shift, tokens, children = self.shift, (1 << self.shift) - 1, self.children.get
        items, ended = [], self._end(state, byte)
        for item in self.items[state >> 8]:
            child = children(item >> shift << 8 | byte, 0)
            if child > tokens:
                items.append(child & ~tokens | item & tokens)
        items.append(ended + 1)
        after = self.next[state | byte] = self._state(tuple(items), ended)
        return after

    def _path(self, ends: list[int], at: int) -> list[int]:
        """The encoding of the first ``at`` bytes since the last emission, read back from its last tokens."""
        path = []
        ended, size = self.ended, self.size
        while at > 0:
            token = ended[ends[at - 1] >> 8]
            path.append(token)
            at -= size[token]
        path.reverse()
        return path

    def transduce(self, data: bytes) -> list[int]:
        """Token ids of one piece's bytes."""
        if len(self.items) >= STATES_KEPT:
            self._reset()
        if not data:
            return []
        out: list[int] = []
        ends: list[int] = []    # states after each byte since the last emission
        after = self.next.get
        state = self.start
        for byte in data[:-1]:
            known = after(state | byte)
            state = self._step(state, byte) if known is None else known
            ends.append(state)
            if len(ends) >= LOOKAHEAD:
                ends = self._emit(ends, state, out)
                if len(self.items) >= STATES_KEPT:
                    ends, state = self._carry(ends, state)
                    after = self.next.get
        # nothing goes on from the last byte, so of its state only the token is needed
        token = self._end(state, data[-1])
        out.extend(self._path(ends, len(ends) + 1 - self.size[token]))
        out.append(token)
        return out

    def _carry(self, ends: list[int], state: int) -> tuple[list[int], int]:
        """Empty the table of states inside a piece; the states after its open bytes go on in the new one."""
        held = [(self.items[s >> 8], self.ended[s >> 8]) for s in (*ends, state)]
        self._reset()
        *ends, state = [self._state(*h) for h in held]
        return ends, state

    def _emit(self, ends: list[int], state: int, out: list[int]) -> list[int]:
        """Emit the tokens that all live items agree on; what stays open is at most a few tokens long."""
        paths = [self._path(ends, len(ends) - self.depth[item >> self.shift]) for item in self.items[state >> 8]]
        same = 0
        for tokens in zip(*paths, strict=False):
            if len(set(tokens)) > 1:
                break
            same += 1
        out.extend(paths[0][:same])
        return ends[sum(self.size[t] for t in out[len(out) - same:]):]

    def piece(self, piece: str) -> tuple[int, ...]:
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode("utf-8")
            whole = self.ranks.get(data)
            ids = (self.ids[whole],) if whole is not None else tuple(self.transduce(data))
            if len(data) > PIECE_BYTES:
                return ids
        if len(self.known) >= PIECES_KEPT:
            self.known, self.older = {}, self.known
        self.known[piece] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        pieces = self.pieces(text or "")
        got = list(map(self.known.get, pieces))
        i = -1
        try:
            while True:
                i = got.index(None, i + 1)
                # a piece that came up earlier in this text is known by now
                piece = pieces[i]
                ids = self.known.get(piece)
                got[i] = self.piece(piece) if ids is None else ids
        except ValueError:  # no unknown piece is left
            return list(chain.from_iterable(got))


def utf8_step(pending: tuple[int, ...], byte: int) -> tuple[str, tuple[int, ...]]:
    """One byte through the UTF-8 machine: (finished text, unfinished bytes)."""
    if not pending:
        if byte < 0x80:
            return chr(byte), FRESH
        return ("", (byte,)) if 0xC2 <= byte <= 0xF4 else ("�", FRESH)
    lead = pending[0]
    low, high = 0x80, 0xBF
    if len(pending) == 1:  # the second byte rules out overlong forms, surrogates and values past U+10FFFF
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, low)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, high)
    if not low <= byte <= high:
        text, after = utf8_step(FRESH, byte)
        return "�" + text, after
    got = (*pending, byte)
    size = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
    if len(got) < size:
        return "", got
    value = lead & (0x7F >> size)
    for b in got[1:]:
        value = value << 6 | b & 0x3F
    return chr(value), FRESH


class Decoder:
    """Streaming decoder: feed token ids, get text; :meth:`finish` closes an unfinished character."""

    def __init__(self, ranks: dict[bytes, int]):
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.edges: dict[tuple, dict[int, tuple]] = {}
        self.state: tuple[int, ...] = FRESH

    def _edge(self, state, token):
        text, now = [], state
        for byte in self.bytes_of[token]:
            done, now = utf8_step(now, byte)
            text.append(done)
        edge = self.edges[state][token] = ("".join(text), now)
        return edge

    def feed(self, ids) -> str:
        out = []
        state = self.state
        edges = self.edges.setdefault(state, {})
        for token in ids:
            edge = edges.get(token)
            if edge is None:
                edge = self._edge(state, token)
            out.append(edge[0])
            if edge[1] is not state:
                state = edge[1]
                edges = self.edges.setdefault(state, {})
        self.state = state
        return "".join(out)

    def finish(self) -> str:
        left, self.state = ("�" if self.state else ""), FRESH
        return left

    def decode(self, ids) -> str:
        self.state = FRESH
        return self.feed(ids) + self.finish()


_codecs: dict[int, tuple[Encoder, Decoder]] = kept_in_worker({})


def _codec(shared) -> tuple[Encoder, Decoder]:
    """The codec of a broadcast vocabulary, built once per Python worker."""
    ranks, pattern = shared.value
    key = hash((len(ranks), pattern, next(iter(ranks))))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = (Encoder(ranks, pattern), Decoder(ranks))
    return _codecs[key]


def _share(spark: SparkSession, path: str | None, pattern: str | None):
    """Broadcast ranks and pattern; a vocabulary file is a fixed list, far below a megabyte or two."""
    if path is None or pattern is None:
        import public_tokenizers
        path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
        pattern = pattern or public_tokenizers.PATTERN
    return spark.sparkContext.broadcast((read_ranks(path), pattern))


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, keep: bool = True) -> DataFrame:
    """``doc_id, lang, source, token_ids`` (those that ``docs`` has) of every whole text.

    Without ``keep``, a task empties the worker's tables when it ends: a place uses its idle workers in
    turn, and steps before may have left several, each of which would come to hold tables of its own.
    """
    shared = _share(docs.sparkSession, path, pattern)
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept), "token_ids array<int>"])

    def work(batches):
        encoder, _ = _codec(shared)
        for b in batches:
            yield {**{c: b[c] for c in kept}, "token_ids": [encoder.encode(t) for t in b["text"]]}
        if not keep:
            del encoder
            empty_worker()

    return map_batches(docs, [*kept, "text"], schema, work)


def decode_ids(rows: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, text`` from ``doc_id, token_ids``; NULL ids decode to the empty text."""
    shared = _share(rows.sparkSession, path, pattern)

    def work(batches):
        _, decoder = _codec(shared)
        for b in batches:
            yield {"doc_id": b["doc_id"], "text": [decoder.decode(ids or ()) for ids in b["token_ids"]]}

    return map_batches(rows, ["doc_id", "token_ids"], "doc_id long, text string", work)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode each text, decode its ids again, and return the digests of both."""
    shared = _share(docs.sparkSession, path, pattern)

    def work(batches):
        encoder, decoder = _codec(shared)
        written = [str(i) for i in range(max(encoder.bytes_of) + 1)]
        sha = hashlib.sha256
        for b in batches:
            out = {"doc_id": b["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in b["text"]:
                ids = encoder.encode(text)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha(",".join([written[i] for i in ids]).encode()).hexdigest())
                out["decoded_sha256"].append(sha(decoder.decode(ids).encode("utf-8")).hexdigest())
            yield out

    return map_batches(docs, ["doc_id", "text"], DIGESTS, work)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: token count and digests of ids and decoded text for every document."""
    return round_trip(table(spark, sf_dir, "documents"))


def token_rows(docs: DataFrame) -> DataFrame:
    """The pipeline's last stage: documents as token ids, with their count."""
    return encode_documents(docs, keep=False).withColumn("n_tokens", F.size("token_ids").cast("long"))
