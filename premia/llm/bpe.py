"""Byte-level BPE by a lazily determinised transducer, and streaming decoding by an incremental UTF-8 machine.

The encoding of a prefix ends in exactly one token, and a token may follow another exactly if the merges leave the two
alone: so the encoding of a text is the path on which all neighbours are such a pair. The transducer reads bytes. Its
state is the set of places where a token may still have begun, each with the node of the vocabulary's trie reached since and
the tokens on the path to it. What all paths have in common is emitted, which is after at most the longest token's
number of bytes. States and moves are made when first met and kept in a table of bounded size.

Decoding compiles every token into a move of the UTF-8 machine, so a stream of ids is cut into valid text at any point.

Defined results: a null text is empty and has no ids; repeated rows get equal ids; ids that are no token raise an
error; bytes that are no UTF-8 decode to the same bytes, with valid = false; of merges of equal rank the leftmost goes first; very long texts
are encoded whole, piece by piece; an empty table gives an empty result;
extra columns are passed on or ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import Recent, documents

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Entries of the tables of moves, which then is started anew, and of pieces, of which the used ones are kept. Parameters of the cost only.
MOVES, PIECES = 450_000, 220_000

# The UTF-8 machine: 0 between characters; 1, 2, 3: so many continuation bytes to come; 4 to 7: the same after a first
# byte that narrows the next one; 8: no UTF-8.
NARROW = {0xE0: (4, 0xA0, 0xBF, 1), 0xED: (5, 0x80, 0x9F, 1), 0xF0: (6, 0x90, 0xBF, 2), 0xF4: (7, 0x80, 0x8F, 2)}


def utf8_step(state: int, byte: int) -> int:
    if state == 0:
        if byte < 0x80:
            return 0
        if byte in NARROW:
            return NARROW[byte][0]
        return 1 if 0xC2 <= byte <= 0xDF else 2 if 0xE1 <= byte <= 0xEF else 3 if 0xF1 <= byte <= 0xF3 else 8
    if state <= 3:
        return state - 1 if 0x80 <= byte <= 0xBF else 8
    for number, low, high, left in NARROW.values():
        if state == number:
            return left if low <= byte <= high else 8
    return 8


class Transducer:
    def __init__(self, ranks: dict):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        # The trie of the vocabulary: for every node its nodes by next byte, and the token that ends there.
        self.nodes: list = [{}]
        self.ends: list = [None]
        self.halves: dict = {}
        for token, i in ranks.items():
            parts, halves = self.merged(token)
            if parts == [i]:  # a token that the merges never make is on no path
                self.halves[i] = halves
                node = 0
                for b in token:
                    if b not in self.nodes[node]:
                        self.nodes[node][b] = len(self.nodes)
                        self.nodes.append({})
                        self.ends.append(None)
                    node = self.nodes[node][b]
                self.ends[node] = i
        self.pairs: dict = {}
        self.restart()

    def restart(self) -> None:
        self.moves: dict = {}
        self.numbers: dict = {}
        self.states: list = []
        # A place: (trie node, tokens since what was emitted). Before anything is read there is no last token.
        self.start = self.number((None, ((0, ()),)))

    def merged(self, data: bytes) -> tuple:
        """Merges by rank: the ids that remain, and the two that the last merge joined (None: no merge)."""
        ranks, parts, last = self.ranks, [data[i : i + 1] for i in range(len(data))], None
        while len(parts) > 1:
            rank, at = min((ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 62:
                break
            last = (ranks[parts[at]], ranks[parts[at + 1]])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[x] for x in parts], last

    def follows(self, a: int, b: int) -> bool:
        """Whether the merges leave the neighbours a, b alone. Goes back through the merges that made them, the latest first; before
        each of them the two parts that met at the border must not have been the better merge. Of equal ranks the left one goes first."""
        key = a << 32 | b
        tokens, ranks, halves = self.tokens, self.ranks, self.halves
        fine, before = True, 1 << 62
        while True:
            joined = ranks.get(tokens[a] + tokens[b])
            if joined is not None and joined < before:
                fine = False
                break
            left, right = halves[a], halves[b]
            if left is not None and (right is None or a > b):
                before, a = a, left[1]
            elif right is not None:
                before, b = b + 1, right[0]
            else:
                break
        if len(self.pairs) >= MOVES:
            self.pairs.clear()
        self.pairs[key] = fine
        return fine

    def number(self, state: tuple) -> int:
        known = self.numbers.get(state)
        if known is None:
            known = self.numbers[state] = len(self.states)
            self.states.append(state)
        return known

    def move(self, state: int, byte: int) -> tuple:
        """Next state and emitted tokens."""
        last, places = self.states[state]
        nodes, ends, pairs = self.nodes, self.ends, self.pairs
        going, ending = [], None
        for node, path in places:
            nearer = nodes[node].get(byte)
            if nearer is None:
                continue
            if ending is None:
                token = ends[nearer]
                if token is not None:
                    before = path[-1] if path else last
                    fine = True if before is None else pairs.get(before << 32 | token)
                    if fine is None:
                        fine = self.follows(before, token)
                    if fine:
                        ending = (*path, token)
            if nodes[nearer]:
                going.append((nearer, path))
        if ending is None:
            raise ValueError("the ranks are no byte-level BPE vocabulary")
        if not going:
            return self.number((ending[-1], ((0, ()),))), ending
        common, shared = 0, going[0][1]
        for _, path in going:
            if not path or path[0] != ending[0]:
                break
        else:  # the first token at least is common to all
            common = 1
            while all(len(path) > common and path[common] == shared[common] for _, path in going) and shared[common] == ending[common]:
                common += 1
        going.append((0, ending))
        if common:
            last, going = ending[common - 1], [(node, path[common:]) for node, path in going]
        if last is not None and all(path for _, path in going):
            last = None  # it matters only to places right behind it
        return self.number((last, tuple(going))), ending[:common]

    def encode(self, data: bytes) -> list:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(self.moves) > MOVES:
            self.restart()
        state, out, moves = self.start, [], self.moves
        for byte in data:
            key = state << 8 | byte
            step = moves.get(key)
            if step is None:
                step = moves[key] = self.move(state, byte)
            state = step[0]
            out += step[1]
        return out + list(self.states[state][1][-1][1])  # the path to the end of the input


class Coder:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.transducer = Transducer(self.ranks)
        self.pattern = regex.compile(pattern)
        self.tokens = self.transducer.tokens
        self.names = {i: str(i) for i in self.tokens}
        self.pieces = Recent(PIECES)
        self.from_start = np.zeros(max(self.tokens, default=0) + 1, np.uint8)
        for i, token in self.tokens.items():
            self.from_start[i] = self.through(0, token)

    @staticmethod
    def through(state: int, data: bytes) -> int:
        for byte in data:
            state = utf8_step(state, byte)
        return state

    def piece(self, piece: str) -> tuple:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = tuple(self.transducer.encode(piece.encode("utf-8", "surrogatepass")))
            if len(piece) < 100:
                self.pieces.put(piece, ids)
        return ids

    def encode(self, text: str | None) -> list:
        out: list = []
        for piece in self.pattern.findall(text or ""):
            out += self.pieces.new.get(piece) or self.piece(piece)
        return out

    def decode(self, ids, state: int = 0) -> tuple:
        """(bytes, state): the state goes into the call for the next ids of the stream; 0: the bytes end between characters."""
        ids = list(ids)
        tokens = self.tokens
        data = b"".join([tokens[i] for i in ids])
        if state == 0:
            odd = np.flatnonzero(self.from_start[np.array(ids, np.int64)])  # all other tokens lead from 0 to 0
            at = 0
            while at < len(odd):
                i = int(odd[at])
                while i < len(ids) and (state != 0 or self.from_start[ids[i]]):
                    state = int(self.from_start[ids[i]]) if state == 0 else self.through(state, tokens[ids[i]])
                    i += 1
                    if state == 8:
                        return data, 8
                    if state == 0:
                        break
                at = int(np.searchsorted(odd, i))
        else:
            state = self.through(state, data)
        return data, state

    def chunks(self, stream):
        """Streaming decode: an iterable of id lists into an iterable of str, cut only between characters."""
        held, state = b"", 0
        for ids in stream:
            data, state = self.decode(ids, state)
            if state == 8:
                raise ValueError("the ids are no UTF-8")
            held += data
            end = len(held)
            while state and end and held[end - 1] & 0xC0 == 0x80:
                end -= 1
            end -= bool(state)
            yield held[:end].decode()
            held = held[end:]
        if state:
            raise ValueError("the ids end within a character")


@lru_cache(2)
def coder(path: str, pattern: str) -> Coder:
    return Coder(path, pattern)


def encoded(text, path: str, pattern: str = public_tokenizers.PATTERN):
    """Column of ids (array<int>) of a text column."""

    @F.pandas_udf("array<int>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([coder(path, pattern).encode(t) for t in texts], dtype=object)

    return of(text)


def decoded(ids, path: str, pattern: str = public_tokenizers.PATTERN):
    """Column of struct(data binary, valid boolean) of a column of ids."""

    @F.pandas_udf("data binary, valid boolean")
    def of(lists: pd.Series) -> pd.DataFrame:
        rows = [coder(path, pattern).decode([] if x is None else x) for x in lists]
        return pd.DataFrame({"data": [d for d, _ in rows], "valid": [s == 0 for _, s in rows]})

    return of(ids)


def round_trip(text, path: str, pattern: str = public_tokenizers.PATTERN):
    """Encodes, then decodes the ids, in one pass: struct(n_tokens, ids_sha256, decoded_sha256, valid)."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, valid boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        c, rows = coder(path, pattern), []
        for t in texts:
            ids = c.encode(t)
            data, state = c.decode(ids)
            names = ",".join([c.names[i] for i in ids])
            rows.append((len(ids), hashlib.sha256(names.encode()).hexdigest(), hashlib.sha256(data).hexdigest(), state == 0))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "valid"])

    return of(text)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, valid of every document."""
    rows = docs.select("doc_id", round_trip(F.col("text"), path or public_tokenizers.path(VOCABULARY)).alias("r"))
    return rows.select("doc_id", "r.*")


def op4_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir))
