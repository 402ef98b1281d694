"""Problem 5: the language of pages and of segments in another language.

Word scores of the six languages are learned from a bounded sample of labelled documents, whose labels are corrected by
a few rounds of re-estimation. The ranges of scripts and letters narrow a word's candidates: a word outside the Latin
ranges has none and counts for nothing, one with letters that only some languages write is theirs. Words not seen in
training are scored by their letter trigrams. A segment is prose by its sentence ends and by how like words its words are.
Viterbi with a switching penalty then labels the words of a whole content, and each
segment takes the language of most of its letters, with a confidence.

Defined cases: null, empty and blank contents, contents without prose, and words of other scripts give no segment; a
record delivered again counts once, its latest delivery stands; of languages with equally many letters on a page the
first in the order of `LANGS` is the main one; a page without metadata or with an error is no case.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import hash_sample

LANGS = ("en", "fr", "de", "es", "tr", "it")
#: Names and codes of the languages (fixed values).
NOTATIONS = {
    "en": ("en", "eng", "english"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "tr": ("tr", "tur", "turkish", "türkçe", "turkce"),
    "it": ("it", "ita", "italian", "italiano"),
}
#: Letters beyond a to z that each language writes (fixed values).
LETTERS = {"en": "", "fr": "àâæçéèêëîïôœùûüÿ", "de": "äöüß", "es": "áéíñóúü", "tr": "çğıöşüâîû", "it": "àèéìíîòóùú"}
#: Labelled documents the scores are learned from, at most.
TRAIN_DOCUMENTS = 3000
#: Rounds in which labels are corrected by the scores learned so far.
ROUNDS = 3
SWITCH = 9.0
LEAST_LETTERS = 40
#: Share of the words of a segment, names apart, that look like words of a language, at least, for it to be prose: with the
#: end of a sentence at the end of a line, and without. A word looks like one if training has seen it, or if its letter
#: trigrams are as likely in some language as those of all but this part of the words of training, other words' trigrams
#: being all that counts. Without the end of a sentence this share must have been seen.
LEAST_WORDS, OPEN_WORDS, OPEN_SEEN, UNLIKELY = 0.45, 0.8, 0.5, 0.1
#: What a language loses by a word with letters outside its ranges.
OUTSIDE = 6.0
WORD = re.compile(r"[^\W\d_]+")
BLANK_LINE = re.compile(r"(?:\r\n|[\n\r  \x0b\x0c\x85])[^\S\n\r]*(?:(?:\r\n|[\n\r  \x0b\x0c\x85])[^\S\n\r]*)+")
SENTENCE_END = re.compile(r"[.!?…][\"'»”’)\]]*[^\S\n\r]*(?:[\n\r]|$)")
ADDRESS = re.compile(r"[\w.+-]+\s*(?:@|[\[(]\s*at\s*[\])])\s*[\w-]+(?:\s*(?:\.|[\[(]\s*dot\s*[\])])\s*[\w-]+)*", re.IGNORECASE)
MEMO_WORDS = 300_000


def label_language(c):
    """Column: the language that a label names, null where it names none of the six."""
    first = F.regexp_extract(F.lower(F.trim(c)), r"^(\p{L}+)", 1)
    out = F.lit(None).cast("string")
    for lang, names in NOTATIONS.items():
        out = F.when(first.isin(*names), F.lit(lang)).otherwise(out)
    return out


class Scores:
    """Log scores of words by language, relative to the best language of the word."""

    def __init__(self, words: dict[str, np.ndarray], grams: dict[str, np.ndarray]):
        self.words, self.grams = words, grams
        self.uses = Counter(g for w in words for g in trigrams(w))
        self.id = uuid.uuid4().hex
        self.rare = min((float(v.min()) for v in grams.values()), default=0.0)
        self.least = -np.inf
        if words:
            self.least = float(np.quantile([self.likeness(w, True) for w in words if len(w) >= 3] or [0.0], UNLIKELY))

    @staticmethod
    def fit(rows: list[tuple[str, str]]) -> "Scores":
        docs = [Counter(WORD.findall(text.lower())) for _, text in rows]
        given = np.array([LANGS.index(lang) for lang, _ in rows], np.int64)
        index: dict[str, int] = {}
        for d in docs:
            for w in d:
                index.setdefault(w, len(index))
        at = [np.fromiter((index[w] for w in d), np.int64, len(d)) for d in docs]
        n = [np.fromiter(d.values(), np.float64, len(d)) for d in docs]
        label = given.copy()
        logs = np.zeros((len(index), len(LANGS)))
        for _ in range(ROUNDS):
            sizes = np.bincount(label, [x.sum() for x in n], len(LANGS)) + 1
            counts = np.tile(3.0 * sizes / sizes.sum(), (len(index), 1))
            for d, lang in enumerate(label):
                counts[at[d], lang] += np.minimum(n[d], 20)
            logs = np.log(counts / counts.sum(0))
            logs = np.maximum(logs - logs.max(1, keepdims=True), -5.0)
            label = np.array([int((logs[at[d]] * np.minimum(n[d], 3)[:, None]).sum(0).argmax()) if len(at[d]) else given[d] for d in range(len(docs))])
        keep = counts.sum(1) >= 5
        words = {w: logs[i].astype(np.float32) for w, i in index.items() if keep[i]}
        grams: dict[str, np.ndarray] = {}
        for w, i in index.items():
            if keep[i]:
                share = np.log1p(counts[i])
                for g in trigrams(w):
                    grams[g] = grams.get(g, 0) + share
        size = np.sum(list(grams.values()), axis=0) if grams else np.ones(len(LANGS))
        grams = {g: np.log((v + 0.5) / (size + 0.5 * len(grams))).astype(np.float32) for g, v in grams.items()}
        return Scores(words, grams)

    def likeness(self, word: str, alone: bool = False) -> float:
        """Mean log probability of the word's trigrams in the language where it is highest; alone: without its own share."""
        found = [self.grams.get(g) for g in trigrams(word)]
        sums = np.mean([np.full(len(LANGS), self.rare, np.float32) if v is None else v for v in found], 0)
        if alone:
            sums = np.mean([self.rare if (n := self.uses.get(g, 0)) < 2 else (v + np.log1p(-1 / n)).max() for g, v in zip(trigrams(word), found)])
        return float(np.max(sums))

    def like_word(self, word: str) -> bool:
        return word in self.words or len(word) >= 3 and self.likeness(word) >= self.least

    def of(self, word: str, name_like: bool = False) -> np.ndarray:
        if foreign(word):
            return np.zeros(len(LANGS), np.float32)
        got = self.words.get(word)
        if got is None and name_like:
            return np.zeros(len(LANGS), np.float32)
        if got is None:
            got = np.zeros(len(LANGS), np.float32)
            hits = [self.grams[g] for g in trigrams(word) if g in self.grams]
            if len(hits) > 1:
                got = np.sum(hits, axis=0)
                got = np.maximum((got - got.max()) * 0.35, -2.0).astype(np.float32)
        odd = {c for c in word if not "a" <= c <= "z"}
        if odd:
            fits = np.array([all(c in LETTERS[lang] for c in odd) for lang in LANGS])
            if fits.any():
                got = got - OUTSIDE * ~fits
        return got.astype(np.float32)


def foreign(word: str) -> bool:
    """Whether no letter of a word is in the Latin ranges."""
    return min(word) > "\u024f"


def trigrams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + 3] for i in range(len(w) - 2)]


def fit(documents: DataFrame) -> Scores:
    """Scores from at most TRAIN_DOCUMENTS labelled documents, chosen by a hash of their id."""
    sample = hash_sample(documents.select("doc_id", label_language(F.col("lang")).alias("lang"), "text"), "doc_id", TRAIN_DOCUMENTS, "lang is not null and length(text) > 200")
    rows = sample.select("lang", "text").toPandas()
    return Scores.fit(list(zip(rows["lang"], rows["text"])))


def viterbi(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """scores: rows x words x languages, padded with 0. The best language of each word, with SWITCH paid per change."""
    n, width, k = scores.shape
    state = np.zeros((n, width), np.int8)
    moved = np.zeros((width, n, k), bool)
    best = np.zeros((width, n), np.int8)
    delta = scores[:, 0].copy()
    r = np.arange(n)
    for t in range(1, width):
        b = delta.argmax(1)
        best[t] = b
        jump = (delta[r, b] - SWITCH)[:, None]
        np.greater(jump, delta, out=moved[t])
        delta = np.maximum(delta, jump) + scores[:, t]
    now = delta.argmax(1)
    for t in range(width - 1, -1, -1):
        state[:, t] = now
        if t:
            now = np.where(moved[t, r, now], best[t], now)
    return state


class Labeller:
    def __init__(self, model: Scores):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((4096, len(LANGS)), np.float32)
        self.known = np.zeros(4096, bool)
        self.seen = np.zeros(4096, bool)
        self.name = np.zeros(4096, bool)
        self.letters = np.zeros(4096, np.int32)

    def lookup(self, words: list[str]) -> np.ndarray:
        for w in set(words).difference(self.index):
            i = len(self.index)
            if i >= len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
                self.seen = np.concatenate([self.seen, np.zeros_like(self.seen)])
                self.name = np.concatenate([self.name, np.zeros_like(self.name)])
                self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
            low = w.replace("İ", "i").lower()
            v = self.model.of(low, w[0].isupper() and not w.isupper())
            if w.isupper() and "I" in w:  # a capital I may stand for a dotless one
                v = np.maximum(v, self.model.of(low.replace("i", "ı")) - 0.5)
            self.table[i] = v - v.max()
            outside = foreign(low)
            self.known[i] = not outside and self.model.like_word(low)
            self.seen[i] = low in self.model.words
            self.name[i] = outside or low not in self.model.words and w[0].isupper() and not w.isupper()
            self.letters[i] = 0 if outside else len(w)
            self.index[w] = i
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def segments(self, contents: list[str | None]) -> tuple[np.ndarray, ...]:
        """(content, segment number, language, letters, confidence) of every prose segment."""
        if len(self.index) > MEMO_WORDS:
            self.forget()
        at: list[int] = []
        seg_no: list[int] = []
        words: list[str] = []
        counts: list[int] = []
        ended: list[bool] = []
        for i, text in enumerate(contents):
            if not text or len(text) < LEAST_LETTERS:
                continue
            parts = BLANK_LINE.split(text.strip()) if "\n\n" in text or BLANK_LINE.search(text) else [text]
            for s, part in enumerate(parts):
                if len(part) >= LEAST_LETTERS:
                    ended.append(SENTENCE_END.search(part) is not None)
                    found = WORD.findall(ADDRESS.sub(" ", part) if "@" in part or "at]" in part or "at)" in part else part)
                    at.append(i)
                    seg_no.append(s)
                    words += found
                    counts.append(len(found))
        if not counts:
            z = np.zeros(0, np.int64)
            return z, z, z, z, np.zeros(0)
        ids = self.lookup(words)
        n = np.array(counts)
        seg = np.repeat(np.arange(len(n)), n)
        letters = np.bincount(seg, self.letters[ids], len(n)).astype(np.int64)
        known = np.bincount(seg, self.known[ids] & ~self.name[ids], len(n))
        plain = n - np.bincount(seg, self.name[ids], len(n))
        seen = np.bincount(seg, self.seen[ids], len(n))
        ends = np.array(ended)
        worded = np.where(ends, known >= LEAST_WORDS * plain, (known >= OPEN_WORDS * plain) & (seen >= OPEN_SEEN * plain))
        prose = (letters >= LEAST_LETTERS) & (plain >= 5) & worded
        content = np.array(at)
        lang = np.zeros(len(ids), np.int64)
        # Viterbi runs over the prose of a whole content, so that its segments share a state
        keep = prose[seg]
        kept, kept_content = ids[keep], content[seg[keep]]
        starts = np.flatnonzero(np.r_[True, kept_content[1:] != kept_content[:-1]]) if len(kept) else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[starts, len(kept)])
        lang_kept = np.zeros(len(kept), np.int64)
        order = np.argsort(sizes, kind="stable")
        i = 0
        while i < len(order):
            j, width = i, 0
            while j < len(order) and j - i < 2048 and (j - i + 1) * (w := int(sizes[order[j]])) <= 400_000 and (j == i or w <= 1.3 * sizes[order[i]] + 4):
                width = w
                j += 1
            if j == i:
                width, j = int(sizes[order[i]]), i + 1
            rows = order[i:j]
            mask = np.arange(width)[None, :] < sizes[rows][:, None]
            where = (starts[rows][:, None] + np.arange(width)[None, :])[mask]
            scores = np.zeros((len(rows), width, len(LANGS)), np.float32)
            scores[mask] = self.table[kept[where]]
            lang_kept[where] = viterbi(scores, sizes[rows])[mask]
            i = j
        lang[keep] = lang_kept
        votes = np.zeros((len(n), len(LANGS)))
        np.add.at(votes, (seg[keep], lang[keep]), self.letters[ids[keep]])
        best = votes.argmax(1)
        sums = np.stack([np.bincount(seg, self.table[ids, k], len(n)) for k in range(len(LANGS))], 1)
        rival = sums.copy()
        rival[np.arange(len(n)), best] = -np.inf
        margin = (sums[np.arange(len(n)), best] - rival.max(1)) / np.maximum(1, n)
        conf = (votes.max(1) / np.maximum(1, letters)) / (1 + np.exp(-6 * margin))
        p = np.flatnonzero(prose)
        return content[p], np.array(seg_no)[p], best[p], letters[p], conf[p]


_LABELLERS: dict[str, Labeller] = {}


def labeller(model: Scores) -> Labeller:
    """The worker's Labeller of a model, with its memo."""
    if model.id not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[model.id] = Labeller(model)
    return _LABELLERS[model.id]


def labelled_segments(elements: DataFrame, model: Scores, keep: tuple[str, ...], content: str = "content") -> DataFrame:
    """The `keep` columns with seg_no, lang, letters and confidence of every prose segment of the contents."""
    shared = elements.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lab = labeller(shared.value)
        for b in batches:
            n = b.num_columns - 1
            texts = b.column(n).to_pylist()
            at, seg, lang, letters, conf = lab.segments(texts)
            take = pa.array(at)
            names = pa.array(LANGS)
            yield pa.RecordBatch.from_arrays(
                [*(c.take(take) for c in b.columns[:n]), pa.array(seg.astype(np.int32)), names.take(pa.array(lang)), pa.array(letters.astype(np.int32)), pa.array(np.round(conf, 4))],
                names=[*b.schema.names[:n], "seg_no", "lang", "letters", "confidence"],
            )

    picked = elements.select(*keep, content)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{kept}, seg_no int, lang string, letters int, confidence double")


def page_segments(elements: DataFrame, model: Scores) -> DataFrame:
    """Prose segments of the latest delivery of each element, with the letters that each language has on the page."""
    rows = labelled_segments(elements.filter(F.length("content") >= LEAST_LETTERS), model, ("file", "page", "block_idx", "elem_id", "ingested_at"))
    rows = rows.repartition("file", "page")
    latest = Window.partitionBy("file", "page", "elem_id").orderBy(F.col("ingested_at").desc_nulls_last())
    return rows.withColumn("d", F.rank().over(latest)).filter("d = 1").dropDuplicates(["file", "page", "elem_id", "block_idx", "seg_no"]).drop("d", "ingested_at", "elem_id")


def main_languages(segments: DataFrame) -> DataFrame:
    """file, page, main language and its share of the page's letters."""
    sums = [F.sum(F.when(F.col("lang") == lang, F.col("letters")).otherwise(0)).alias(lang) for lang in LANGS]
    per_page = segments.groupBy("file", "page").agg(*sums)
    most = F.greatest(*LANGS)
    main = F.coalesce(*[F.when(F.col(lang) == most, F.lit(lang)) for lang in LANGS])
    return per_page.select("file", "page", main.alias("main"), F.round(most / sum((F.col(x) for x in LANGS[1:]), F.col(LANGS[0])), 4).alias("share"))


def page_labels(page_meta: DataFrame) -> DataFrame:
    """file, page, labelled: the latest delivery of each page that did not fail."""
    latest = Window.partitionBy("file", "page").orderBy(F.col("processed_at").desc_nulls_last(), F.col("language"))
    return (
        page_meta.repartition("file", "page")
        .withColumn("d", F.row_number().over(latest))
        .filter("d = 1 and error is null")
        .select("file", "page", label_language(F.col("language")).alias("labelled"))
    )


def languages(elements: DataFrame, page_meta: DataFrame, model: Scores) -> DataFrame:
    """Page rows (block_idx = seg_no = -1) with the main language, and segment rows; labelled, main, confidence."""
    segments = page_segments(elements.select("file", "page", "block_idx", "elem_id", "ingested_at", "content"), model)
    pages = main_languages(segments).join(page_labels(page_meta), ["file", "page"])
    page_rows = pages.select("file", "page", F.lit(-1).alias("block_idx"), F.lit(-1).alias("seg_no"), F.col("main").alias("lang"), "main", "labelled", F.col("share").alias("confidence"))
    segment_rows = segments.join(pages.drop("share"), ["file", "page"]).select("file", "page", "block_idx", "seg_no", "lang", "main", "labelled", "confidence")
    return page_rows.unionByName(segment_rows)
