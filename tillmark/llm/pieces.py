"""SentencePiece encoding and decoding by a shared-prefix forward search.

Text is marked (one space in front, spaces as U+2581) and cut into marked words:
a run of marks and what follows up to the next mark. No piece reaches over such
a border. The distinct words of a slice are sorted, which lays them out as the
depth-first order of their trie; the forward states of the common prefix with
the word before are reused, so every trie node is computed once.

The forward state of a prefix names its last piece and where that starts:

* unigram models: the last piece of the best-scored segmentation (Viterbi; of
  equal scores the longest last piece wins);
* BPE models: a segmentation is the one that merging by score gives exactly when
  every two neighbours stay apart if merged alone. So the last piece of a prefix
  is the only one compatible with the last piece before it, and the same search
  gives the same ids as merging. Compatibility is looked up once per pair.

Characters without a piece become byte pieces, or the unknown id if the model
has none.

Only models with the identity normalisation, a dummy prefix and kept spaces are
accepted. Model files are read where they lie; every executor needs the path.

Defined results: null and empty texts have no pieces and decode to the empty
text; very long words are searched in time linear in their length; repeated rows
are encoded alike. A text that itself holds U+2581 decodes with spaces there.
"""

from __future__ import annotations

import gc
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
# Words remembered by a task; then it starts anew with those it met again. Verdicts on pairs of pieces are kept longer.
REMEMBERED, VERDICTS = 150_000, 400_000
# Text bytes of a slice: its words weigh many times as much.
TOGETHER = 1 << 19
UNIGRAM, BPE = 1, 2
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceModel:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str = MODEL, kind: int | None = None):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = _model_fields(model.serialized_model_proto())
        if proto["normaliser"] != "identity" or not proto["dummy_prefix"] or proto["drops_spaces"]:
            raise ValueError("only models with identity normalisation, dummy prefix and kept spaces")
        self.kind = kind or proto["kind"]
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        self.unknown = model.unk_id()
        self.text: list[str] = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.size = len(self.text)
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) for i in range(len(self.text))]
        self.ids = {p: i for i, p in enumerate(self.text) if not special[i]}
        self.scores = [model.get_score(i) for i in range(len(self.text))]
        self.byte = {int(self.text[i][3:5], 16): i for i in range(len(self.text)) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.silent = {i for i in range(len(self.text)) if model.is_control(i)}
        self.floor = min((self.scores[i] for i in self.ids.values()), default=0.0) - 10.0
        self.beginnings = {p[:i] for p in self.ids for i in range(len(p) + 1)}
        self.nodes: dict[str, tuple] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.apart: dict[int, dict[int, bool]] = {}
        self.ids_of_loose: dict[str, int] = {}
        self.again: set[str] = set()
        self.root = self._node("")

    # -------------------------------------------------------------- which pieces survive merging

    def merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """What merging by score, then leftmost, leaves of a short text; the two parts of the last merge."""
        parts, latest = list(text), None
        while True:
            best, where = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, where = self.scores[piece], i
            if best is None:
                return parts, latest
            latest = (parts[where], parts[where + 1])
            parts[where : where + 2] = [parts[where] + parts[where + 1]]

    def reachable(self, number: int) -> bool:
        """Whether merging rebuilds the piece from its characters; notes the parts it is made of last."""
        if number not in self.parts:
            left, latest = self.merged(self.text[number])
            if len(left) > 1:
                return False
            # Characters without a piece get a number of their own.
            self.parts[number] = latest and tuple(self._number(part) for part in latest)
        return True

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether two reachable pieces (left: -1 for none) survive merging of their joined text.

        Undoes the merges next to the border, the latest first. The pieces join
        if a pair that faced each other had a better merge than the one undone.
        """
        if left < 0:
            return True
        text, scores, worse = self.text, self.scores, (-float("inf"), True)
        while True:
            joined = self.ids.get(text[left] + text[right])
            if joined is not None and (scores[joined] > worse[0] or worse[1] and scores[joined] == worse[0]):
                return False
            a, b = self._last_merge(left), self._last_merge(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and scores[left] < scores[right]:
                worse, left = (scores[left], False), a[1]  # of equal merges the left one came first
            else:
                worse, right = (scores[right], True), b[0]

    def _number(self, piece: str) -> int:
        number = self.ids.get(piece)
        if number is None:
            number = self.ids_of_loose.setdefault(piece, len(self.text))
            if number == len(self.text):
                self.text.append(piece)
                self.scores.append(self.floor)
        return number

    def _last_merge(self, number: int) -> tuple[int, int] | None:
        if number not in self.parts:
            self.reachable(number)
        return self.parts[number]

    # -------------------------------------------------------------- forward search

    def _node(self, tail: str) -> tuple:
        """Matching state after a text whose longest piece beginning is ``tail``.

        Holds the tail, the states after a next character (filled as met) and the
        pieces that end here, the longest first, as (length, id, verdicts), where
        verdicts tell for each piece before it whether both stay apart.
        """
        node = self.nodes.get(tail)
        if node is None:
            numbers = [(len(tail) - i, self.ids[tail[i:]]) for i in range(len(tail)) if tail[i:] in self.ids]
            ends = tuple(
                (length, number, self.apart.setdefault(number, {})) for length, number in numbers
                if self.kind == UNIGRAM or self.reachable(number)
            )
            node = self.nodes[tail] = (tail, {}, ends)
        return node

    def _after(self, node: tuple, char: str) -> tuple:
        tail = node[0] + char
        while tail not in self.beginnings:
            tail = tail[1:]
        node[1][char] = found = self._node(tail)
        return found

    def encode_words(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct marked words, in the depth-first order of their trie."""
        found: dict[str, tuple[int, ...]] = {}
        scored = self.kind == UNIGRAM
        extend = self._best_scored if scored else self._compatible
        # Forward states by prefix length: matching state, last piece (-1: none), score.
        nodes, last, totals, before = [self.root], [-1], [0.0], ""
        widths = list(map(len, self.text[: self.size]))
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            before = word
            del nodes[shared + 1 :], last[shared + 1 :]
            if scored:
                del totals[shared + 1 :]
            extend(word, shared, nodes, last, totals)
            ids: list[int] = []
            add, end = ids.append, len(word)
            while end:
                piece = last[end]
                if piece >= 0:
                    add(piece)
                    end -= widths[piece]
                else:
                    ids.extend(reversed(self._fallback(word[end - 1])))
                    end -= 1
            ids.reverse()
            found[word] = tuple(ids)
        return found

    def _compatible(self, word: str, shared: int, nodes: list, last: list, totals: list) -> None:
        """Extend the states of a BPE model: the only piece compatible with the one before it."""
        node, end = nodes[-1], shared
        add_node, add_last = nodes.append, last.append
        for char in word[shared:]:
            end += 1
            after = node[1]
            node = after[char] if char in after else self._after(node, char)
            best = -1
            for length, number, verdicts in node[2]:
                left = last[end - length]
                if left not in verdicts:
                    verdicts[left] = self.stay_apart(left, number)
                if verdicts[left]:
                    best = number
                    break
            add_node(node)
            add_last(best)

    def _best_scored(self, word: str, shared: int, nodes: list, last: list, totals: list) -> None:
        """Extend the states of a unigram model: the best-scored segmentation of each prefix."""
        for end in range(shared + 1, len(word) + 1):
            node = nodes[-1][1].get(word[end - 1]) or self._after(nodes[-1], word[end - 1])
            best, total = -1, None
            for length, number, _ in node[2]:
                score = totals[end - length] + self.scores[number]
                if total is None or score > total:
                    best, total = number, score
            if not node[2] or node[2][-1][0] > 1:
                score = totals[end - 1] + self.floor
                if total is None or score > total:
                    best, total = -1, score
            nodes.append(node)
            last.append(best)
            totals.append(total)

    def _fallback(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode()] if self.byte else [self.unknown]

    # -------------------------------------------------------------- whole texts

    @staticmethod
    def marked(text: str) -> list[str]:
        return _WORDS.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, texts: list[str], known: dict[str, bytes]) -> list[list[int]]:
        """Ids of each text; ``known`` remembers the ids of words, as bytes of 32-bit integers, between calls."""
        split = [self.marked(t) for t in texts]
        self.learn(split, known)
        return [array("i", b"".join(map(known.__getitem__, words))).tolist() for words in split]

    def learn(self, split: list[list[str]], known: dict[str, bytes]) -> dict[str, tuple[int, ...]]:
        """Add the words that ``known`` lacks; returns them."""
        words = set(chain.from_iterable(split))
        if len(known) > REMEMBERED:
            kept = {word: known[word] for word in self.again if word in known}
            known.clear()
            self.again.clear()
            if len(kept) <= REMEMBERED // 2:
                known.update(kept)
            if sum(map(len, self.apart.values())) > VERDICTS:
                for verdicts in self.apart.values():
                    verdicts.clear()
        unknown = words.difference(known)
        self.again.update(words.difference(unknown))
        new = self.encode_words(unknown)
        known.update((word, array("i", ids).tobytes()) for word, ids in new.items())
        return new

    def decodes_to(self, word: str, ids: tuple[int, ...]) -> bool:
        """Whether ids inside a text decode to a marked word."""
        # Byte pieces, unknown and control ids are named by more characters than they stand for, so then these differ.
        return "".join(map(self.text.__getitem__, ids)) == word or self.decode(ids, inside=True) == word.replace(MARK, " ")

    def decode(self, ids: Iterable[int], inside: bool = False) -> str:
        """The text of the ids; ``inside`` keeps the space that stands for the dummy prefix."""
        parts = bytearray()
        for i in ids:
            if i in self.byte_of:
                parts.append(self.byte_of[i])
            elif i not in self.silent:
                parts += (" ⁇ " if i == self.unknown else self.text[i]).encode()
        text = parts.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") and not inside else text


def _model_fields(model: bytes) -> dict:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model)
    return {
        "kind": proto.trainer_spec.model_type, "normaliser": proto.normalizer_spec.name,
        "dummy_prefix": proto.normalizer_spec.add_dummy_prefix, "drops_spaces": proto.normalizer_spec.remove_extra_whitespaces,
    }


ENCODED = "doc_id bigint, n_pieces bigint, ids array<int>, round_trip boolean"


def encode_documents(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """Piece ids of each document (doc_id, text), and whether they decode to the same text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the word tables hold no cycles and would be walked again and again
        try:
            model, known, broken = PieceModel(path), {}, set()
            for batch in slices(batches, "text", TOGETHER):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                split = [model.marked(t) for t in texts]
                # Pieces of a word decode apart from those of other words, so each distinct word is decoded once.
                for word, ids in model.learn(split, known).items():
                    if not model.decodes_to(word, ids):
                        broken.add(word)
                found = [b"".join(map(known.__getitem__, words)) for words in split]
                sizes = [len(x) // 4 for x in found]
                ids = np.frombuffer(b"".join(found), np.int32)
                same = [MARK not in t and (not broken or broken.isdisjoint(words)) for t, words in zip(texts, split)]
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), lists, pa.array(same, pa.bool_())],
                    ["doc_id", "n_pieces", "ids", "round_trip"],
                )
        finally:
            gc.enable()  # workers go on with other stages
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def decode_documents(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """Texts of rows (doc_id, ids); null ids give the empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(path)
        for batch in batches:
            texts = [model.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
