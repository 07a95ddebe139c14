"""SentencePiece BPE encoding and decoding by a weighted finite-state transducer.

Compiled from the model, three machines are composed with an input:

* **normaliser**: identity on characters with ``space -> ▁`` and, if the model says so, a leading ``▁``;
* **pieces**: arcs from position to position that read a piece of the vocabulary and write its id, and for a
  character that is no piece, the arc that writes its UTF-8 bytes (byte fallback) or the unknown id;
* **agreement**: an acceptor over neighbouring pieces. Its weight is 0 if the pair is what BPE makes of the
  two pieces' joint text, else infinite.

The encoding is the shortest path in the tropical semiring. A sequence is the BPE of its text exactly if
each neighbouring pair is the BPE of the pair's text, so one path has a finite weight, each prefix has one
finite state, and the search, depth first, enters no position twice. The pieces alone, weighted by their scores,
would not give BPE's result, which is why the agreement machine is composed in.

No piece of the vocabulary holds a ``▁`` behind another character, so the lattice falls apart before each
run of ``▁``; units between are composed once each and remembered per Python worker, up to ``KNOWN_UNITS``.
A vocabulary with such a piece is composed with whole texts.

Defined results: NULL and empty texts have no pieces (NULL text: NULL ids and NULL decoded text). Decoding
gives the normalised text with ``▁`` as space and without the leading space of the normaliser; a raw ``▁``
therefore comes back as a space. ``round_trip`` compares with exactly that. Repeated rows repeat.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frames import arrow_column, remember_as

MODEL = "piece_bpe_32k.model"
MARK = "▁"
KNOWN_UNITS = 320_000
KNOWN_PAIRS = 250_000
NEVER = float("inf")


class Transducer:
    """The composed machines of one model."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        if spec.trainer_spec.model_type != 2 or spec.normalizer_spec.precompiled_charsmap:
            raise ValueError("a BPE model with the identity normaliser is needed")
        if spec.normalizer_spec.remove_extra_whitespaces or not spec.normalizer_spec.escape_whitespaces:
            raise ValueError("white space must be kept and escaped")
        self.prefix = spec.normalizer_spec.add_dummy_prefix
        processor = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.unknown = processor.unk_id()
        self.ids, self.ranks, self.bytes = {}, {}, [-1] * 256
        self.written: list[bytes] = []
        for i, piece in enumerate(spec.pieces):
            raw = piece.piece.encode()
            if piece.type == 6:  # byte
                value = int(piece.piece[1:-1], 16)
                self.bytes[value] = i
                raw = bytes([value])
            elif piece.type in (1, 4, 5):  # normal, user-defined, unused
                self.ids[piece.piece] = i
                self.ranks[piece.piece] = -piece.score
            elif piece.type == 3:  # control
                raw = b""
            else:
                raw = " ⁇ ".encode()
            self.written.append(raw.replace(MARK.encode(), b" ") if piece.type != 6 else raw)
        cut = any(MARK in p.lstrip(MARK) for p in self.ids)
        self.units = re.compile(".+" if cut else f"{MARK}*[^{MARK}]+|{MARK}+", re.DOTALL)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # Arcs of the piece machine as a trie by prefix: what is written, or nothing for an inner node.
        self.arcs = {p[:n]: b"" for p in self.ids for n in range(1, len(p))}
        self.arcs |= {p: np.int32(i).tobytes() for p, i in self.ids.items()}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.trees: dict[str, tuple | None] = {}

    def merged(self, text: str) -> list[str]:
        """BPE of a short text by its definition: merge the best pair, the leftmost on a tie."""
        parts = list(text)
        while len(parts) > 1:
            pairs = [self.ranks.get(a + b, NEVER) for a, b in zip(parts[:-1], parts[1:], strict=True)]
            if (low := min(pairs)) == NEVER:
                break
            at = pairs.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def tree(self, piece: str) -> tuple | None:
        """(right edge, left edge) of a piece's merge tree, from the leaf up; None if BPE splits the piece.

        An entry is a node and the rank of the merge that takes it into its parent. ``()`` stands for a tree
        whose merges are not in the order of their ranks.
        """
        if piece in self.trees:
            return self.trees[piece]
        ranks, parts, splits = self.ranks, list(piece), {}
        while len(parts) > 1:
            pairs = [ranks.get(a + b, NEVER) for a, b in zip(parts[:-1], parts[1:], strict=True)]
            if (low := min(pairs)) == NEVER:
                break
            at = pairs.index(low)
            whole = parts[at] + parts[at + 1]
            splits[whole] = parts[at], parts[at + 1]
            parts[at : at + 2] = [whole]
        found: tuple | None = None
        if len(parts) == 1:
            edges, ordered = [], True
            for side in (1, 0):
                edge, node = [(piece, NEVER)], piece
                while len(node) > 1:
                    child = splits[node][side]
                    ordered &= all(len(c) == 1 or ranks[c] < ranks[node] for c in splits[node])
                    edge.append((child, ranks[node]))
                    node = child
                edges.append(edge[::-1])
            inner = all(len(c) == 1 or ranks[c] < ranks[w] for w, pair in splits.items() for c in pair)
            found = tuple(edges) if ordered and inner else ()
        self.trees[piece] = found
        return found

    def agree(self, left: str, right: str) -> bool:
        """Weight of the agreement machine: True for 0, False for infinity.

        Merges happen in the order of their ranks, so only the nodes at the seam matter: the pair fails
        if two of them would merge across it before either is taken into its own piece. On equal ranks the
        merge further left comes first. Trees with other orders are settled by BPE itself.
        """
        after = self.tree(right)
        if not left or after is None:
            return after is not None
        before = self.tree(left)
        if not before or not after:
            return self.merged(left + right) == [left, right]
        ranks, a, b, i, j = self.ranks, before[0], after[1], 0, 0
        while True:
            (x, up), (y, down) = a[i], b[j]
            seam = ranks.get(x + y, NEVER)
            if seam < up and seam <= down and seam < NEVER:
                return False
            if up == down == NEVER:
                return True
            if up <= down:
                i += 1
            else:
                j += 1

    def weigh(self, left: str, right: str) -> bool:
        """``agree``, remembered."""
        if len(self.pairs) > KNOWN_PAIRS:
            self.pairs.clear()
        found = self.pairs[left, right] = self.agree(left, right)
        return found

    def shortest_path(self, text: str) -> bytes:
        """Ids, as little-endian int32, on the path of finite weight.

        Searched depth first, the longest piece ahead. A position has one finite state, so a position that led to no
        end is never entered again.
        """
        end, arcs, pairs, weigh = len(text), self.arcs, self.pairs, self.weigh
        taken: list[tuple[int, str, list[int]]] = []
        dead: set[int] = set()
        i, left, ends = 0, "", None
        while i < end:
            if ends is None:
                ends = []
                for j in range(i + 1, end + 1):
                    written = arcs.get(text[i:j])
                    if written or j == i + 1:
                        ends.append(j)
                    if written is None:
                        break
            while ends:
                j = ends.pop()
                if j in dead:
                    continue
                piece = text[i:j]
                good = pairs.get((left, piece))
                if weigh(left, piece) if good is None else good:
                    taken.append((i, left, ends))
                    i, left, ends = j, piece, None
                    break
            else:
                dead.add(i)
                i, left, ends = taken.pop()
        path = [left]
        path += [piece for _, piece, _ in reversed(taken)]
        return b"".join([arcs.get(piece) or self.fallback(piece) for piece in reversed(path) if piece])

    def fallback(self, char: str) -> bytes:
        """What the fallback arc of a character writes."""
        raw = [self.bytes[b] for b in char.encode()]
        return np.array(raw if min(raw) >= 0 else [self.unknown], "<i4").tobytes()

    def normalise(self, text: str) -> str:
        text = text.replace(" ", MARK)
        return MARK + text if text and self.prefix else text

    def encode(self, text: str) -> np.ndarray:
        units = self.units.findall(self.normalise(text))
        known = self.known
        try:
            return np.frombuffer(b"".join([known[u] for u in units]), "<i4")
        except KeyError:
            self.learn(set(units))
            known = self.known
            return np.frombuffer(b"".join([known[u] for u in units]), "<i4")

    def learn(self, units: set[str]) -> None:
        """Compose the units not remembered. Memory has two halves, so that units in use stay."""
        if len(self.known) > KNOWN_UNITS // 2:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        for unit in units:
            if unit not in known:
                known[unit] = older.get(unit) or self.shortest_path(unit)

    def decode(self, ids: np.ndarray) -> str:
        written = self.written
        text = b"".join([written[i] for i in ids.tolist()]).decode(errors="replace")
        return text[1:] if self.prefix and text[:1] == " " else text

    def expected(self, text: str) -> str:
        """What decoding must give back."""
        return text.replace(MARK, " ")


@lru_cache(maxsize=2)
def transducer(model: str) -> Transducer:
    import public_tokenizers

    remember_as(__name__, transducer.cache_clear)
    return Transducer(public_tokenizers.path(model))


def encoded(text: str | Column, model: str = MODEL) -> Column:
    """struct<ids, round_trip> of a text."""

    def batch(texts: list[str | None]) -> pa.Array:
        machine = transducer(model)
        ids = [None if t is None else machine.encode(t) for t in texts]
        whole = [None if i is None else machine.decode(i) == machine.expected(t) for i, t in zip(ids, texts, strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.list_(pa.int32())), pa.array(whole, pa.bool_())], ["ids", "round_trip"]
        )

    return arrow_column(batch, "struct<ids:array<int>,round_trip:boolean>", text)


def decoded(ids: str | Column, model: str = MODEL) -> Column:
    """Text of an array of ids."""

    def batch(lists: list[list[int] | None]) -> pa.Array:
        machine = transducer(model)
        return pa.array([None if x is None else machine.decode(np.array(x, np.int32)) for x in lists], pa.string())

    return arrow_column(batch, "string", ids)


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL
) -> DataFrame:
    """doc_id, pieces (ids), n_pieces, round_trip for every row."""
    done = docs.select(F.col(id_col).alias("doc_id"), encoded(F.col(text_col), model).alias("e"))
    return done.select(
        "doc_id",
        F.col("e.ids").alias("pieces"),
        F.coalesce(F.size("e.ids"), F.lit(0)).cast("long").alias("n_pieces"),
        F.col("e.round_trip").alias("round_trip"),
    )
