"""License scans by template markup compiled to token automata.

A template is license wording with ``<<beginOptional>> ... <<endOptional>>`` regions, which
may be left out, and ``<<var;min=0;max=8>>`` regions, which stand for any few words. It is
compiled to a nondeterministic automaton over words; a place in a text is accepted when
its words lead the automaton to its end, so all mandatory wording matches exactly: a license
with a changed, missing or additional term is not accepted. Templates are whole licenses
and headers, or notices that name a license behind a verb of granting. Texts that lack one
of a template's mandatory words are never tried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroad.llm import common
from tallyroad.llm.license_texts import NEGATIONS, NOTICES, PHRASES, TEXTS

#: Scores of a text with a whole license or header, with a notice, and with base phrases alone.
WHOLE, NOTICE, BASE = 1.0, 0.75, 0.5
_SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90))
#: Separators to blanks and A-Z to a-z in one step; bytes from 80 stay, so this is exact on UTF-8.
_TABLE = bytes.maketrans(_SEPARATORS + common.UPPER.encode(), b" " * len(_SEPARATORS) + common.LOWER.encode())


def split_words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass
class Automaton:
    """States are numbers; ``word`` and ``any`` edges read one word, ``skip`` edges none."""

    word: list[dict[bytes, int]] = field(default_factory=list)
    any: list[int | None] = field(default_factory=list)
    skip: list[list[int]] = field(default_factory=list)
    mandatory: set[bytes] = field(default_factory=set)

    def state(self) -> int:
        self.word.append({})
        self.any.append(None)
        self.skip.append([])
        return len(self.word) - 1

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.skip[todo.pop()]:
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return frozenset(out)

    def ends(self, words: list[bytes], start: int) -> int | None:
        """Number of the word after the longest match from ``start``, or None."""
        here, last, at = self.closure({0}), None, start
        final = len(self.word) - 1
        while here:
            if final in here:
                last = at
            if at >= len(words):
                break
            w = words[at]
            step = {self.word[s][w] for s in here if w in self.word[s]} | {self.any[s] for s in here if self.any[s] is not None}
            here, at = self.closure(step), at + 1
        return last

    def starts(self) -> set[bytes]:
        return {w for s in self.closure({0}) for w in self.word[s]}


def compile_template(markup: str) -> Automaton:
    """Compile a template; raises ValueError for unbalanced or unknown markup, or if no word is mandatory."""
    made = Automaton()
    at, opened = made.state(), []
    for part in re.split(r"(<<[^>]*>>)", markup):
        if part == "<<beginOptional>>":
            opened.append(at)
        elif part == "<<endOptional>>":
            if not opened:
                raise ValueError("endOptional without beginOptional")
            end = made.state()
            made.skip[at].append(end)
            made.skip[opened.pop()].append(end)
            at = end
        elif m := re.fullmatch(r"<<var;min=(\d+);max=(\d+)>>", part):
            low, high = map(int, m.groups())
            passed = []
            for k in range(high):
                if k >= low:
                    passed.append(at)
                made.any[at] = made.state()
                at = made.any[at]
            for s in passed:
                made.skip[s].append(at)
            nxt = made.state()
            made.skip[at].append(nxt)
            at = nxt
        elif part.startswith("<<"):
            raise ValueError(f"unknown markup {part}")
        else:
            for w in split_words(part.encode()):
                made.word[at][w] = made.state()
                at = made.word[at][w]
                if not opened:
                    made.mandatory.add(w)
    if opened or not made.mandatory:
        raise ValueError("open optional region, or nothing mandatory")
    end = made.state()
    made.skip[at].append(end)
    return made


class Scanner:
    """Automata of whole texts (label -> markup) and of notices (label -> markups)."""

    def __init__(self, texts: dict[str, str] | None = None, notices: dict[str, list[str]] | None = None):
        whole = TEXTS if texts is None else texts
        short = NOTICES if notices is None else notices
        self.automata = [(k, WHOLE, compile_template(v)) for k, v in whole.items()] + [(k, NOTICE, compile_template(v)) for k, each in short.items() for v in each]
        self.phrases = [(tuple(p.encode().split()), label) for p, label in PHRASES.items()]
        self.negations = {w.encode() for w in NEGATIONS}
        # every phrase and template needs one of these words; checked on the raw bytes first
        self.signs = [b"license", *sorted({max(sorted(a.mandatory), key=len) for _, _, a in self.automata if b"license" not in a.mandatory})]

    def spans(self, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, word after the last, score) of the longest matches from left to right of each template; a notice behind a negation grants nothing."""
        out, present, places = [], set(words), {}
        for label, score, automaton in self.automata:
            if not present >= automaton.mandatory:
                continue
            starts = automaton.starts()
            if not places:
                for i, w in enumerate(words):
                    places.setdefault(w, []).append(i)
            free = 0
            for i in sorted(i for w in starts for i in places.get(w, ())):
                if i < free or score == NOTICE and self.negations.intersection(words[max(0, i - 2) : i]):
                    continue
                if (end := automaton.ends(words, i)) is not None:
                    out.append((label, i, end, score))
                    free = end
        return out

    def scan(self, text: bytes) -> dict:
        lowered = text.translate(_TABLE)
        words = lowered.split()
        base: list[tuple[int, str]] = []
        spans: list[tuple[str, int, int, float]] = []
        if any(s in lowered for s in self.signs):
            present = set(words)
            for phrase, label in self.phrases:
                if present.issuperset(phrase):
                    base += [(i, label) for i, w in enumerate(words) if w == phrase[0] and tuple(words[i : i + len(phrase)]) == phrase]
            spans = self.spans(words)
        base_labels = {x for _, x in base}
        starts = [i for i, _ in base]
        return {
            "n_words": len(words), "n_base": len(base), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(base_labels | {x[0] for x in spans})),
            "score": max([x[3] for x in spans], default=BASE if base else 0.0), "spans": [{"label": x, "start": a, "end": b} for x, a, b, _ in spans],
        }


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
     ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
)


def license_scan(docs: DataFrame, texts: dict[str, str] | None = None, notices: dict[str, list[str]] | None = None) -> DataFrame:
    """Scan every whole text for the base phrases and the templates.

    ``docs`` needs doc_id and text. Returns doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score (WHOLE where a license's or header's whole wording stands, else NOTICE where a notice names
    a license, else BASE with base phrases alone, else 0) and ``spans`` (label, first word, word after the
    last). Null and empty texts have no words and empty labels; repeated rows and null ids give a row each;
    an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(texts, notices)
        for batch in batches:
            rows = [{"doc_id": i} | scanner.scan(t or b"") for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)

    kinds = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:bigint,end:bigint>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, kinds)


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(common.read(spark, sf_dir, "documents"))
