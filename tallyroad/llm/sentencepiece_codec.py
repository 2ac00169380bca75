"""SentencePiece encoding and decoding by shared-prefix Viterbi.

The distinct marked words of a batch are sorted, which is a depth-first walk over their
trie; the forward scores of the common prefix with the word before are kept, and only the
remaining characters are extended. Pieces that end at a character are found in a trie of
reversed pieces. A character that no piece covers falls back to its UTF-8 bytes.

A unigram model's best path has the largest sum of scores. A merge model's scores are
priorities and don't add up, but its encoding is a path of the same kind: any part of it
is the encoding of that part, so the piece that ends a prefix is the one that stays whole
beside the piece before it, and merging the two pieces' characters tells whether it does.
Both kinds give the ids that the model defines.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroad.llm import common

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: What an uncovered character costs below the worst piece.
UNKNOWN = 10.0
#: Distinct words that a worker keeps with their pieces, and characters of texts taken together.
KEPT_WORDS, BLOCK_CHARS = 400_000, 2_000_000
#: Pairs of pieces that a worker knows to stay side by side or not.
KEPT_PAIRS = 1_000_000


@dataclass
class Vocabulary:
    """Pieces with scores; ``bytes_`` has the ids of the 256 byte pieces, empty without byte fallback; ``merges`` says that scores are priorities."""

    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    bytes_: list[int]
    unknown: int
    merges: bool = False

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        """Read a model file; raises ValueError for models whose texts this codec would prepare in another way."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(Path(path).read_bytes())
        kind, prepared = model.trainer_spec, model.normalizer_spec
        if kind.model_type not in (kind.UNIGRAM, kind.BPE):
            raise ValueError("only unigram and merge models are read")
        if prepared.precompiled_charsmap or not prepared.add_dummy_prefix or prepared.remove_extra_whitespaces or not prepared.escape_whitespaces or kind.treat_whitespace_as_suffix:
            raise ValueError("only models that mark blanks and the text's start, and change nothing else, are read")
        pieces = [p.piece for p in model.pieces]
        types = [p.type for p in model.pieces]
        one = type(model.pieces[0]) if pieces else sentencepiece_model_pb2.ModelProto.SentencePiece
        if one.USER_DEFINED in types or one.UNUSED in types:
            raise ValueError("user-defined and unused pieces are not read")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p, t in zip(pieces, types, strict=True) if t == one.NORMAL):
            raise ValueError("a piece crosses the start of a word")
        of_byte = {p: i for i, (p, t) in enumerate(zip(pieces, types, strict=True)) if t == one.BYTE}
        return cls(pieces, [p.score for p in model.pieces], [t == one.NORMAL for t in types], [of_byte[f"<0x{b:02X}>"] for b in range(256)] if len(of_byte) == 256 else [], types.index(one.UNKNOWN), kind.model_type == kind.BPE)


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.v = v = vocabulary
        # reversed pieces: a character's entry is the piece that is complete with it, or -1, and the entries of longer ones
        self.root: dict[str, tuple] = {}
        ends: dict = {}
        for i, (piece, ok) in enumerate(zip(v.pieces, v.normal, strict=True)):
            if ok:
                node = ends
                for ch in reversed(piece):
                    node = node.setdefault(ch, {})
                node[""] = i  # no character is empty, so this key is free
        #: characters of a piece, and the longest shorter piece that it ends with
        self.sizes, self.shorter = [len(p) for p in v.pieces], [-1] * len(v.pieces)
        todo = [(ends, self.root, -1)]
        while todo:
            node, entries, last = todo.pop()
            for ch, below in node.items():
                if ch:
                    whole = below.get("", -1)
                    entries[ch] = (whole, {})
                    if whole >= 0:
                        self.shorter[whole] = last
                    todo.append((below, entries[ch][1], whole if whole >= 0 else last))
        self.scores = {p: x for p, x, ok in zip(v.pieces, v.scores, v.normal, strict=True) if ok}
        self.unknown_score = min(self.scores.values(), default=0.0) - UNKNOWN
        alone = [c for c in "\n\t\r" if not any(c in p for p in self.scores)]
        self.cut = re.compile(f"[{''.join(alone)}]|{MARK}*[^{MARK}{''.join(alone)}]+|{MARK}+" if alone else f"{MARK}*[^{MARK}]+|{MARK}+")
        byte_of = {i: bytes([b]) for b, i in enumerate(v.bytes_)}
        self.raw = [byte_of.get(i, p.encode() if ok else (" ⁇ ".encode() if i == v.unknown else b"")) for i, (p, ok) in enumerate(zip(v.pieces, v.normal, strict=True))]
        #: whether a piece stays whole behind another one, by the one before (0 for none)
        self.beside: list[dict[int, bool]] = [{} for _ in range(len(v.pieces) + 1)]
        self.pairs = 0
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)
        self.word_scores = np.zeros(0)

    def mark(self, text: str) -> list[str]:
        """Marked words of a text: runs of blanks with what follows them."""
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def merged(self, text: str) -> list[str]:
        """Characters merged by priority, the leftmost of equals first."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.scores[x], k) for k in range(len(parts) - 1) if (x := parts[k] + parts[k + 1]) in self.scores]
            if not found:
                break
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def stays(self, before: int, piece: int) -> bool:
        """Whether a piece stays whole behind another one (or behind none or an uncovered character, -1)."""
        whole = [self.v.pieces[i] for i in (before, piece) if i >= 0]
        if self.pairs >= KEPT_PAIRS:
            for row in self.beside:
                row.clear()
            self.pairs = 0
        self.pairs += 1
        known = self.beside[before + 1][piece] = self.merged("".join(whole)) == whole
        return known

    def _merge_on(self, word: str, first: int, back: list[int], piece_at: list[int]) -> None:
        """Extend the forward state of a merge model by the characters from ``first``: the longest piece that stays beside what is before it."""
        root, beside, sizes, shorter, stays = self.root, self.beside, self.sizes, self.shorter, self.stays
        for end in range(first, len(word) + 1):
            entries, at, piece = root, end, -1
            while at and (entry := entries.get(word[at - 1])) is not None:
                at -= 1
                whole, entries = entry
                if whole >= 0:
                    piece = whole
            start = end - 1
            while piece >= 0:
                start = end - sizes[piece]
                before = piece_at[start]
                if (ok := beside[before + 1].get(piece)) or ok is None and stays(before, piece):
                    break
                piece = shorter[piece]
            back.append(start if piece >= 0 else end - 1)
            piece_at.append(piece)

    def _add_on(self, word: str, first: int, best: list[float], back: list[int], piece_at: list[int]) -> None:
        """Extend the forward scores of a unigram model by the characters from ``first``."""
        root, scores = self.root, self.v.scores
        for end in range(first, len(word) + 1):
            top, start, chosen = best[end - 1] + self.unknown_score, end - 1, -1
            entries, at = root, end
            while at and (entry := entries.get(word[at - 1])) is not None:
                at -= 1
                piece, entries = entry
                if piece >= 0 and (s := best[at] + scores[piece]) >= top:  # the longer of equals
                    top, start, chosen = s, at, piece
            best.append(top)
            back.append(start)
            piece_at.append(chosen)

    def add(self, words: set[str]) -> None:
        """Encode new distinct words in sorted order, extending the forward scores of common prefixes."""
        v, merges, merge_on, add_on = self.v, self.v.merges, self._merge_on, self._add_on
        before, best, back, piece_at = "", [0.0], [0], [-1]
        ids, counts, uncovered = [], [], []
        n = len(self.index)
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word):  # noqa: B905  the shorter one ends it
                if x != y:
                    break
                shared += 1
            del best[shared + 1 :], back[shared + 1 :], piece_at[shared + 1 :]
            if merges:
                merge_on(word, shared + 1, back, piece_at)
            else:
                add_on(word, shared + 1, best, back, piece_at)
            out, end, missed = [], len(word), 0
            while end:
                start, piece = back[end], piece_at[end]
                if piece >= 0:
                    out.append(piece)
                else:
                    missed += 1
                    if v.bytes_:
                        out.extend(v.bytes_[b] for b in reversed(word[start:end].encode("utf-8", "replace")))
                    else:
                        out.append(v.unknown)
                end = start
            out.reverse()
            self.index[word] = n
            n += 1
            ids += out
            counts.append(len(out))
            uncovered.append(missed)
            before = word
        if not counts:
            return
        fresh, sizes = np.array(ids, np.int32), np.array(counts, np.int64)
        of_piece = np.array([x if ok else 0.0 for x, ok in zip(v.scores, v.normal, strict=True)])
        ends = np.cumsum(sizes)
        sums = np.add.reduceat(np.append(of_piece[fresh], 0.0), ends - sizes) * (sizes > 0)
        self.word_scores = np.concatenate([self.word_scores, sums + np.array(uncovered) * self.unknown_score])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + ends])
        self.ids = np.concatenate([self.ids, fresh])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, float]]:
        """(piece ids, Viterbi score) of each whole text."""
        if len(self.index) > KEPT_WORDS:
            self.forget()
        marked = [self.mark(t) for t in texts]
        self.add({w for m in marked for w in m}.difference(self.index))
        ids, offsets, scores = self.ids, self.offsets, self.word_scores
        out = []
        for m in marked:
            at = np.fromiter(map(self.index.__getitem__, m), np.int64, len(m))
            begin, count = offsets[at], offsets[at + 1] - offsets[at]
            ends = np.cumsum(count)
            total = int(ends[-1]) if len(m) else 0
            own = ids[np.repeat(begin - ends + count, count) + np.arange(total)] if total else ids[:0]
            if not self.v.bytes_ and total:  # unknown pieces side by side are one, also across words
                own = own[np.append(True, (own[1:] != self.v.unknown) | (own[:-1] != self.v.unknown))]
            out.append((own, float(scores[at].sum())))
        return out

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.raw.__getitem__, ids.tolist())).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def _run(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            doc_ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size + len(texts[high]) <= BLOCK_CHARS):
                    size += len(texts[high])
                    high += 1
                coded = codec.encode(texts[low:high])
                decoded = [codec.decode(i) for i, _ in coded]
                counts = np.array([len(i) for i, _ in coded], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.slice(low, high - low),
                        pa.array([len(t) for t in texts[low:high]], pa.int64()),
                        pa.array(counts),
                        pa.array([s for _, s in coded], pa.float64()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(np.concatenate([i for i, _ in coded]) if coded else np.zeros(0, np.int32), pa.int32())),
                        pa.array([hashlib.sha256(d.encode("utf-8", "replace")).hexdigest() for d in decoded]),
                        pa.array([d == t for d, t in zip(decoded, texts[low:high], strict=True)]),
                    ],
                    names=["doc_id", "n_chars", "n_pieces", "score", "ids", "decoded_sha256", "exact"],
                )
                low = high

    return run


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Encode every whole text and decode it again.

    ``docs`` needs doc_id and text. Returns doc_id, n_chars, n_pieces, score (sum of piece scores on the
    best path; a merge model's scores are priorities), ids, decoded_sha256 and exact (the decoded text is the text). Null and empty texts have no
    pieces. A literal U+2581 is read as a blank, as SentencePiece does, and then exact is false. Repeated
    rows and null ids give a row each; an empty table gives an empty table. The vocabulary has a fixed size
    and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    return base.mapInArrow(_run(shared), "doc_id long, n_chars long, n_pieces long, score double, ids array<int>, decoded_sha256 string, exact boolean")


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_documents(common.read(spark, sf_dir, "documents"))
