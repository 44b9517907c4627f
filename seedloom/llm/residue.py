"""Template residue, filler, error pages and script notices in place of content.

Method: labelled exemplars are kept in an inverted index (stem to exemplars). The text of a record, without code and
quotations, is cut into passage windows: sentences, overlapping windows of a long one, and every placeholder by itself. Each window
retrieves the exemplars of a kind that share its stems, the nearest first, and is compared with them by TF-IDF containment: the share of
the window's weight that they cover. A window with high coverage by residue marks the record, unless exemplars of
genuine talk speak for the sentence it stands in. Document frequencies are counted over all records, in a hashed table of
fixed size. Whole texts are read; both passes are map-only but for the sum of the counts.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Mapping, Sequence
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.exemplars import FUNCTION_WORDS, GENUINE, KINDS

#: Slots of the hashed table of document frequencies.
SLOTS = 1 << 17
#: Share of a window's weight that the exemplars of one kind have to cover.
COVERED = 0.7
#: Exemplars that may cover a window together.
TOGETHER = 3
#: Share that the best of them has to cover alone.
ALONE = 0.4
#: No word weighs more than this share of the greatest weight, so that one that the corpus hardly has doesn't decide alone.
HEAVIEST = 0.6
#: A function word weighs at most this share.
LIGHT = 0.3
#: Share of the best exemplar's own weight that a window has to have; a window with one word besides function words needs most of it.
PRESENT, WHOLE = 0.2, 0.5
#: A window weighs at least this share of the greatest weight; a placeholder always does.
LEAST = 0.55
#: A word is rare from this share of the greatest weight.
RARE = 0.25
#: Rare words that only genuine talk has and that a placeholder that is meant needs around it.
TALK = 2
#: Share of the weight around a placeholder that genuine talk has to cover.
MEANT = 0.5
#: Kinds whose exemplars are bags of words, and the words that a window of them needs: different ones of dummy text, any of mashed keys.
BAGS = {"dummy text": 4, "mash": 2}
#: Words of a window and of the step to the next, in sentences longer than a window.
WINDOW, STEP = 16, 8
#: Letters of a stem.
STEM = 6
#: Words that a task remembers.
REMEMBERED = 100_000

SLOT = "⟦slot⟧"
_NAME = r"[A-Za-z][\w.]*"
# What a form asks for, marks that people put in brackets, and tags that are written about.
_ASKS = r"(?:[Yy]our|[Ii]nsert|[Ee]nter|[Aa]dd|[Tt]ype|YOUR|INSERT|ENTER|ADD|TYPE)"
_MARKS = r"(?:Answered|Closed|Deleted|Duplicate|Edit|Edited|Fixed|Image|Moved|Note|Photo|Quote|Removed|Resolved|Sic|Solved|Update|Updated|Video)"
_TAGS = r"(?:a|b|br|code|div|em|form|h[1-6]|head|hr|html|i|img|input|li|link|meta|ol|option|p|pre|script|select|span|strong|style|table|td|th|tr|ul|video)"
# Placeholders of template languages, shells, format strings, mail merges and forms.
_PLACEHOLDER = re.compile(
    rf"\{{\{{\{{?[#^&]?\s*{_NAME}(?:\s*\|\s*[\w: ]+)*\s*\}}?\}}\}}|\$\{{{_NAME}\}}(?!/)|#\{{{_NAME}\}}|\{{[$!]{_NAME}\}}|\{{(?:{_NAME}|\d)\}}|\[\[{_NAME}\]\]|\[%\s*{_NAME}\s*%\]"
    rf"|%\({_NAME}\)[sd]|%[A-Za-z][A-Za-z_]*%|(?<![\w%]) ?%[sd](?!\w)|\$[A-Z][A-Z_]+\$|\*\|[A-Z][A-Z_:]*\|\*|__[A-Z][A-Z_]*__|@@{_NAME}@@|<%=?\s*{_NAME}\s*%>|<<\s*[A-Za-z][\w ]*>>|<\?=?\s*\$?{_NAME}\s*\?>"
    rf"|<{_ASKS} [\w ]+>|&lt;(?!/?{_TAGS}\b)[a-z][\w ]*&gt;|\[{_ASKS} [\w ]+\](?![(:])|\[[A-Z][A-Z]+(?:[ _][A-Z]+)*\](?![(:])|\[(?!{_MARKS}\b)[A-Z][a-z]+(?:[ _][A-Za-z]+)?\](?![(:\[])"
)
_FENCE = re.compile(r"^(```|~~~).*?(?:^\1[^\n]*$|\Z)", re.M | re.S)
_INLINE = re.compile(r"`[^`\n]+`")
_QUOTED = re.compile(r"\"[^\"\n]{2,}\"|“[^”\n]{2,}”|„[^“”\n]{2,}[“”]|«[^»\n]{2,}»|(?<!\w)'[^'\n]{2,}'(?!\w)")
_QUOTE, _OPENING = re.compile("[\"'“„«]"), re.compile(r"[{%_@<\[&$*]")  # what a quotation or a placeholder can start with
_CODE_LINE = re.compile(r"\{%|[;{]\s*$|=>|\w\(.*\)\s*:?\s*$|^\s*(?:for|if|while|try|except|with|def|return|const|let|var|import|do|done|else)\b.*[:;)=]?\s*$.*[=({]|\w\s*[+\-]?=\s*\S|^\s*(?:SELECT|FROM|WHERE|GROUP BY|ORDER BY|JOIN)\b|^\s*\./|</?(?:li|td|tr|ul)>|^\s*(?:try:|done|do|else:|\}\)?;?)\s*$")
_PLAIN_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|\n|</?[a-z]\w*[^<>]*>|\s\|\s")
_WORD = re.compile(r"⟦slot⟧|[^\W_]+")
_BLOCKS = re.compile(r"\n[ \t]*\n")
_HEX = re.compile(r"[a-f]{4,}")
_REPEATED = re.compile(r"(.)\1\1+")


def stem(word: str) -> str | None:
    """The stem of a word in small letters; None for numbers and references (runs with a digit, or of hexadecimal letters only)."""
    if word == SLOT:
        return word
    if not word.isalpha() or word[0] < "g" and _HEX.fullmatch(word):
        return None
    return _REPEATED.sub(r"\1\1\1", word)[:STEM]


_FUNCTION = frozenset(s for w in FUNCTION_WORDS.split() if (s := stem(w)))


def stems(text: str) -> list[str]:
    return [s for w in _WORD.findall(text.casefold()) if (s := stem(w))]


def prose(text: str) -> str:
    """A text without code, inline code and quotations; placeholders outside them become slots."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
    text = text.replace("\r\n", "\n")
    if "```" in text or "~~~" in text:
        text = _FENCE.sub("\n", text)
    kept = []
    for block in _BLOCKS.split(text):
        lines = [x for x in block.split("\n") if x.strip() and not x.lstrip().startswith(">")]
        if not lines:
            continue
        if all(x[0] in " \t" for x in lines) or len(lines) > 1 and 2 * sum(bool(_CODE_LINE.search(x)) for x in lines) > len(lines) or len(lines) == 1 and "{%" in lines[0]:
            continue
        kept.append("\n".join(lines))
    text = "\n\n".join(kept)
    if "`" in text:
        text = _INLINE.sub(" ", text)
    if not (text.startswith("{") and text.endswith("}")):  # the members of a bare JSON object aren't quotations
        text = _QUOTED.sub(" ", text) if _QUOTE.search(text) else text
    return _PLACEHOLDER.sub(f" {SLOT} ", text) if _OPENING.search(text) else text


def sentences(text: str) -> list[list[str]]:
    """Sentences of the prose of a text as lists of words in small letters."""
    text = prose(text)
    pattern = _SENTENCE if "<" in text or "|" in text else _PLAIN_SENTENCE
    return [found for part in pattern.split(text.casefold()) if part and (found := _WORD.findall(part))]


def slot_of(word: str) -> int:
    return zlib.crc32(word.encode()) % SLOTS


class ResidueIndex:
    """Inverted index of the exemplars, with weights from document frequencies."""

    def __init__(self, n: int, counts: Sequence[int], kinds: Mapping[str, Sequence[str]] = KINDS, genuine: Sequence[str] = GENUINE):
        self.n, self.counts = n, counts
        self.most = log(n + 1) + 0.1
        parts = [(kind, part) for kind, texts in {**kinds, "genuine": genuine}.items() for text in texts for part in ([text] if kind in BAGS else _PLAIN_SENTENCE.split(text))]
        self.exemplars: list[tuple[str, frozenset[str]]] = [(kind, ss) for kind, part in parts if (ss := frozenset(stems(part)))]
        self.index: dict[str, list[int]] = {}
        for i, (_, ss) in enumerate(self.exemplars):
            for s in ss:
                self.index.setdefault(s, []).append(i)
        self.residue = {s for s, at in self.index.items() if any(self.exemplars[i][0] != "genuine" for i in at)}
        self.talk = {s for s, at in self.index.items() if any(self.exemplars[i][0] == "genuine" for i in at)}
        self.sums = [sum(map(self.weight, ss)) for _, ss in self.exemplars]
        self._known: dict[str, tuple[float, float, str | None]] = {}

    def weight(self, s: str) -> float:
        """Inverse document frequency of a stem."""
        return min(0.1 + log((self.n + 1) / (self.counts[slot_of(s)] + 1)), (LIGHT if s in _FUNCTION else HEAVIEST) * self.most)

    def known(self, word: str) -> tuple[float, float, str | None]:
        """Weight of a word, the part of it that residue can cover at all, and its stem; the words met most recently are remembered."""
        if len(self._known) > REMEMBERED:
            self._known.clear()
        s = stem(word)
        w = self.weight(s) if s else 0.0
        out = self._known[word] = (w, w if s in self.residue else 0.0, s)
        return out

    def _covered(self, window: dict[str, float], allowed: Callable[[str], bool]) -> tuple[float, float, float]:
        """Coverage of a window by the TOGETHER best exemplars of the allowed kinds, by the best one alone, and the share of that one in the window."""
        near = {i for s in window for i in self.index.get(s, ()) if allowed(self.exemplars[i][0])}
        left, shares, present = dict(window), [], 0.0
        while near and len(shares) < TOGETHER:  # the exemplar that adds most; of equals the one with less else in it
            gain, _, i = max((sum(left.get(s, 0.0) for s in self.exemplars[i][1]), -self.sums[i], i) for i in near)
            if not shares:
                present = sum(self.weight(s) for s in self.exemplars[i][1] if s in window) / self.sums[i]
            shares.append(gain)
            for s in self.exemplars[i][1]:
                left.pop(s, None)
        total = sum(window.values())
        return sum(shares) / total, (shares[0] / total if shares else 0.0), present

    def _meant(self, sentence: list[str]) -> bool:
        """Whether genuine talk covers the words of a sentence around its placeholders; it takes TALK rare ones that only genuine talk has."""
        weights = {s: w for x in sentence for w, _, s in [self._known.get(x) or self.known(x)] if s and s != SLOT}
        here = [w for s, w in weights.items() if s in self.talk]
        own = sum(w >= RARE * self.most and s not in self.residue for s, w in weights.items() if s in self.talk)
        return own >= TALK and sum(here) >= MEANT * sum(weights.values())

    def score(self, window: list[str]) -> float:
        """Coverage of a window of words by residue, 0 if genuine talk is nearer or covers as much."""
        weights: dict[str, float] = {}
        for x in window:
            w, _, s = self._known.get(x) or self.known(x)
            if s:
                weights[s] = weights.get(s, 0.0) + w
        if not weights:
            return 0.0
        if sum(weights.values()) < LEAST * self.most:
            return 0.0
        best, one, present = self._covered(weights, lambda kind: kind not in BAGS and kind != "genuine")
        told = sum(s in self.residue and s not in _FUNCTION for s in weights)
        if one < ALONE or present < (PRESENT if told > 1 else WHOLE):
            best = 0.0
        for kind, least in BAGS.items():
            if len(weights if kind == "dummy text" else window) >= least:
                best, one = max((best, one), (self._covered(weights, kind.__eq__)[0], 1.0))
        if best >= COVERED:
            coverage, alone, _ = self._covered(weights, "genuine".__eq__)
            if alone > one or coverage > best:
                return 0.0
        return best

    def coverage(self, text: str) -> float:
        """The greatest coverage of a window of a text."""
        best, known, look = 0.0, self._known, self.known
        for sentence in sentences(text):
            if SLOT in sentence:
                # The placeholder by itself is a window, which its exemplar covers; what stands around it tells whether it is meant.
                if not self._meant(sentence):
                    best = max(best, self._covered({SLOT: 1.0}, "placeholder".__eq__)[0])
            facts = [known.get(x) or look(x) for x in sentence]
            windows = [(0, len(sentence))]
            if len(sentence) > WINDOW:
                windows += [(k, k + WINDOW) for k in range(0, len(sentence) - STEP, STEP)]
            for a, b in windows:
                total = possible = 0.0
                for w, p, _ in facts[a:b] if b - a < len(facts) else facts:
                    total += w
                    possible += p
                if possible > best * total:  # else no exemplars can cover more than was found already
                    if possible >= COVERED * total and total > 0:
                        best = max(best, self.score([x for x in sentence[a:b] if x != SLOT]))
        return best


def _count(batches):
    import numpy as np
    import pyarrow as pa

    counts, n = np.zeros(SLOTS, np.int64), 0
    place: dict[str, int] = {}
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                n += 1
                seen = set()
                for w in set(_WORD.findall(text.casefold())):
                    k = place.get(w)
                    if k is None:
                        if len(place) > REMEMBERED:
                            place.clear()
                        s = stem(w)
                        k = place[w] = slot_of(s) if s else -1
                    seen.add(k)
                seen.discard(-1)
                if _OPENING.search(text) and _PLACEHOLDER.search(text):
                    seen.add(slot_of(SLOT))
                counts[np.fromiter(seen, np.int64, len(seen))] += 1
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(counts[at], n))], ["slot", "n"])


def document_frequencies(documents: DataFrame, text: str = "text") -> tuple[int, list[int]]:
    """Number of records with a text, and the records per hashed stem; the driver gets at most SLOTS + 1 sums."""
    rows = documents.select(text).where(F.col(text).isNotNull()).mapInArrow(_count, "slot bigint, n bigint")
    table = rows.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts, n = [0] * SLOTS, 0
    for k, v in zip(table["slot"].to_pylist(), table["n"].to_pylist(), strict=True):
        if k < 0:
            n = v
        else:
            counts[k] = v
    return n, counts


def residue_coverage(documents: DataFrame, id: str = "doc_id", text: str = "text", corpus: DataFrame | None = None, **exemplars) -> DataFrame:
    """Coverage by residue of every record: id, coverage from 0 to 1. Document frequencies are those of ``corpus``, or of the records.

    NULL and empty texts have coverage 0; coverage below COVERED may be given as 0. Repeated rows give repeated rows; other columns are left
    out. An empty table gives no rows. Exemplars may be given as ``kinds``, lists of texts by kind, and ``genuine``.
    """
    n, counts = document_frequencies(documents if corpus is None else corpus, text)
    shared = documents.sparkSession.sparkContext.broadcast((n, counts))  # SLOTS numbers, whatever the size of the input
    kind = documents.schema[id].dataType

    def run(batches):
        import pyarrow as pa

        index = ResidueIndex(*shared.value, **exemplars)
        for batch in batches:
            found = [index.coverage(t) if t else 0.0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["id", "coverage"])

    return documents.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind.simpleString()}, coverage double").withColumnRenamed("id", id)


def residue_documents(documents: DataFrame, id: str = "doc_id", text: str = "text", covered: float = COVERED, corpus: DataFrame | None = None) -> DataFrame:
    """Ids of the records to exclude, with their coverage."""
    return residue_coverage(documents, id, text, corpus).where(F.col("coverage") >= covered)
