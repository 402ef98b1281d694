"""Problem 8: keyword-stuffed and link-list pages.

One narrow pass turns each text into raw measures of its content and links: how well it compresses, how its words and word
pairs repeat, how often function words come, how long the runs without one are, how much of it is links, marks, codes and
numbers, and how its lines look. None of them says what spam is. Nine weak signals, each of one side of a page, vote spam or
honest or abstain; a page with two votes for a side, and more than for the other, is weakly labelled, others stay unlabelled. Bagged decision trees
trained on a bounded sample of weak labels score every page. The score's log odds are then moved by those of the spam rate
of the page's host, without the page itself, by a weight fitted on pages that a tree has not seen.

Defined cases: null, empty and blank texts are no spam; equal texts have equal features; a page of no host is scored
alone; where no page has a weak label, or all have the same, every page scores alike and none is spam unless all are
labelled so. Scores have no cut on length: whole texts are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import hash_sample, written

#: Frequent function words of the six languages (fixed values).
FUNCTION_WORDS = frozenset(
    """the of and to in a is that it was for on with as by at from has have had been be are this which not we you will our
    le la les de des du un une et est que qui dans pour sur avec au aux ce cette par ne pas nous vous se sont a été il elle
    der die das den dem des ein eine und ist in zu mit auf für von nicht sich wir sie hat haben im am wird dass es
    el los las del una y en es por con para se al lo su no hay que ha han nuestra
    bir ve bu için ile da de olarak daha çok kadar sonra gibi olan ne en o hâlâ önce yeni tekrar üç hiçbir kimse bunları göre nedeniyle olduğu lütfen
    il lo gli della dei delle di e è per con non si ha che nel alla le un""".split()
)
URL = re.compile(r"(?:https?|hxxps?)://\S+|\bwww\.\S+|\b[a-z0-9-]{3,}(?:\.[a-z0-9-]{3,})+(?:/[^\s)>\"]*)?")
WORD = re.compile(r"[^\W\d_]+")
MIXED = re.compile(r"[^\W\d_][\d@$]|[\d@$][^\W\d_]")
MARKS = "#|;/»•<>[]·*=~"
UNLEET = str.maketrans("0134@$5", "oieaass")
FEATURES = (
    "compressed", "function_share", "gap_share", "longest_gap", "distinct_share", "top_word", "top_five", "pair_repeats", "near_repeats", "url_share", "url_per_word", "linked_lines", "mixed_share", "number_share", "number_variety",
    "leaders", "mark_share", "anchor_share", "line_words", "line_distinct", "line_heads", "line_ends", "line_numbers", "ends_per_word", "commas_per_word", "capitals", "word_length", "log_words", "log_lines",
)
AT = {name: i for i, name in enumerate(FEATURES)}
#: A run of so many words without a function word counts as a gap; a content word counts as a near repeat within so many.
GAP, NEAR = 7, 24
#: Weakly labelled pages the trees are trained on, at most.
TRAIN_PAGES = 8000
TREES, DEPTH, LEAST_LEAF, BINS, SEED = 31, 7, 6, 32, 17
#: Pages that the overall rate counts as in a host's rate; bounds of rates and scores before their odds are taken.
HOST_PRIOR, CLIP = 20.0, 0.002
SALT = 16


def features(text: str) -> list[float] | None:
    """Values of FEATURES, None for a text without words and links."""
    low = text.lower()
    tokens = text.split()
    t = max(1, len(tokens))
    mixed = sum(1 for x in tokens if MIXED.search(x))
    urls = URL.findall(low) if "." in text or "://" in text else []
    bare = URL.sub(" ", low) if urls else low
    words = WORD.findall(bare.translate(UNLEET) if mixed > 0.2 * t else bare)
    if not words and not urls:
        return None
    n = max(1, len(words))
    is_function = FUNCTION_WORDS.__contains__
    counts = Counter(words)
    content = sorted((c for w, c in counts.items() if not is_function(w)), reverse=True)
    at = [i for i, w in enumerate(words) if is_function(w)]
    gaps = np.diff(np.array([-1, *at, n])) - 1
    pairs = Counter(zip(words, words[1:]))
    last: dict[str, int] = {}
    near = 0
    for i, w in enumerate(words):
        if i - last.get(w, -NEAR - 1) <= NEAR and not is_function(w):
            near += 1
        last[w] = i
    lines = [x for x in map(str.strip, text.splitlines()) if x] or [text]
    m = len(lines)
    ends = sum(map(text.count, ".!?"))
    numbers = [x for x in tokens if x[0].isdigit() and not MIXED.search(x)]
    raw = text.encode("utf-8", "replace")
    return [
        len(zlib.compress(raw, 1)) / (len(raw) + 40), len(at) / n, float(gaps[gaps >= GAP].sum()) / n, float(np.log1p(gaps.max())), len(counts) / n**0.85, (content[0] if content else 0) / n,
        sum(content[:5]) / n, sum(c for c in pairs.values() if c > 1) / n, near / n, sum(map(len, urls)) / max(1, len(text)), len(urls) / n, sum("://" in x or "www." in x for x in lines) / m,
        mixed / t, len(numbers) / t, len(set(numbers)) / t, text.count("....") / m, sum(map(text.count, MARKS)) / t, (low.count("<a ") + low.count("[url")) / n,
        n / m, len(set(lines)) / m, len({x.split(" ", 1)[0] for x in lines}) / m, sum(x[-1] in ".!?" for x in lines) / m, sum(x[-1].isdigit() for x in lines) / m, ends / n, text.count(",") / n,
        sum(x[0].isupper() for x in tokens) / t, sum(map(len, words)) / n, float(np.log1p(n)), float(np.log1p(m)),
    ]


def votes(f: list[float]) -> list[int]:
    """What each weak signal says of a page: 1 spam, -1 honest, 0 nothing. Each looks at another side of it: words that
    come again at once, packing, links, running prose, amounts, one leading word, words with digits in them, lines that end in figures, marks."""
    x = dict(zip(FEATURES, f))
    linked = x["url_per_word"] > 0.05
    return [
        1 if x["near_repeats"] > 0.5 else -1 if x["near_repeats"] < 0.12 and not linked and x["log_words"] > 3 else 0,
        1 if x["compressed"] < 0.25 and x["log_words"] > 4 else -1 if x["compressed"] > 0.55 and not linked else 0,
        1 if x["url_per_word"] > 0.12 and x["function_share"] < 0.12 or x["anchor_share"] > 0.05 else 0,
        -1 if x["function_share"] > 0.2 and x["gap_share"] < 0.35 and x["top_word"] < 0.06 else 1 if x["function_share"] < 0.02 and x["number_share"] < 0.03 and x["log_words"] > 4 else 0,
        -1 if x["number_variety"] > 0.08 or x["leaders"] > 0.5 else 0,
        1 if x["top_word"] > 0.12 and x["number_share"] < 0.1 else -1 if x["top_word"] < 0.04 and not linked else 0,
        1 if x["mixed_share"] > 0.3 else 0,
        -1 if x["line_numbers"] > 0.6 and x["line_distinct"] > 0.95 and x["log_lines"] > 1.5 else 0,
        1 if x["mark_share"] > 0.6 and x["function_share"] < 0.05 and x["leaders"] == 0 else 0,
    ]


def weak_label(f: list[float]) -> int | None:
    """The side that at least two signals vote for and more than for the other, None where there is none."""
    v = votes(f)
    spam, honest = v.count(1), v.count(-1)
    return 1 if spam >= 2 and spam > honest else 0 if honest >= 2 and honest > spam else None


def page_features(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "origin"), text: str = "text") -> DataFrame:
    """The `keep` columns, `f` (FEATURES) and `weak` of every page with words or links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for i, t in enumerate(b.column(len(keep)).to_pylist()):
                if t and (f := features(t)) is not None:
                    at.append(i)
                    rows.append(f)
            flat = pa.array(np.array(rows, np.float32).ravel() if rows else np.zeros(0, np.float32))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), flat)
            weak = pa.array([weak_label(f) for f in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at, pa.int64())) for c in b.columns[:-1]), lists, weak], names=[*keep, "f", "weak"])

    picked = docs.select(*keep, text)
    kept = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{kept}, f array<float>, weak int")


class Trees:
    """Bagged decision trees on binned features: each tree sees a bootstrap sample and, at each node, a random third of
    the features; a leaf holds its share of spam."""

    def __init__(self, edges: list[np.ndarray], trees: list[np.ndarray]):
        self.edges, self.trees = edges, trees
        #: Of each training page, the mean score of the trees that did not see it; not sent to the workers.
        self.unseen = np.zeros(0)

    def __getstate__(self) -> dict:
        return {"edges": self.edges, "trees": self.trees, "unseen": np.zeros(0)}

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray) -> "Trees":
        rng = np.random.default_rng(SEED)
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        third = max(2, x.shape[1] // 3)
        rarer = int(min(y.sum(), len(y) - y.sum()))
        least = max(1, min(LEAST_LEAF, rarer // 4))  # few pages of a kind need small leaves
        trees: list[np.ndarray] = []
        unseen, times = np.zeros(len(y)), np.zeros(len(y))
        for _ in range(TREES):
            rows: list[list[float]] = []

            def grow(at: np.ndarray, depth: int) -> int:
                me = len(rows)
                mean = (y[at].sum() + 0.5) / (len(at) + 1)
                rows.append([-1, 0, 0, 0, mean])
                if depth == DEPTH or len(at) < 2 * least or y[at].min() == y[at].max():
                    return me
                best = (1e-9, -1, 0)
                total, ones = len(at), y[at].sum()
                for j in rng.permutation(x.shape[1])[:third]:
                    c = np.bincount(binned[at, j], minlength=BINS + 1).cumsum()[:-1]
                    s = np.bincount(binned[at, j], y[at], minlength=BINS + 1).cumsum()[:-1]
                    ok = (c >= least) & (total - c >= least)
                    if ok.any():
                        gain = np.where(ok, s**2 / np.maximum(c, 1) + (ones - s) ** 2 / np.maximum(total - c, 1) - ones**2 / total, -1)
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (gain[k], int(j), k)
                if best[1] >= 0:
                    left = binned[at, best[1]] <= best[2]
                    rows[me][:2] = [best[1], best[2]]
                    rows[me][2] = grow(at[left], depth + 1)
                    rows[me][3] = grow(at[~left], depth + 1)
                return me

            seen = rng.integers(0, len(y), len(y))
            grow(seen, 0)
            trees.append(np.array(rows))
            out = np.bincount(seen, minlength=len(y)) == 0
            unseen += np.where(out, Trees.walk(trees[-1], binned), 0)
            times += out
        model = Trees(edges, trees)
        model.unseen = np.where(times > 0, unseen / np.maximum(times, 1), y.mean())
        return model

    @staticmethod
    def walk(tree: np.ndarray, binned: np.ndarray) -> np.ndarray:
        at = np.zeros(len(binned), np.int64)
        for _ in range(DEPTH):
            j = tree[at, 0].astype(np.int64)
            left = binned[np.arange(len(binned)), np.maximum(j, 0)] <= tree[at, 1]
            at = np.where(j >= 0, np.where(left, tree[at, 2], tree[at, 3]).astype(np.int64), at)
        return tree[at, 4]

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], 1)
        return np.mean([self.walk(t, binned) for t in self.trees], 0)


def train(pages: DataFrame) -> tuple[Trees, list[tuple[str | None, float, int]]]:
    """Trees from at most TRAIN_PAGES weakly labelled pages, chosen by a hash of their id, spam and honest alike; and of
    each of these pages with a host (host, score of the trees that did not see it, label)."""
    totals = dict(pages.groupBy("weak").count().collect())
    rows = []
    for label in (0, 1):
        if n := totals.get(label):
            rows += hash_sample(pages.filter(F.col("weak") == label).select("doc_id", "origin", "f", "weak"), "doc_id", TRAIN_PAGES // 2, total=n).select("origin", "f", "weak").collect()
    if not rows:
        return Trees.fit(np.zeros((1, len(FEATURES)), np.float32), np.zeros(1)), []
    model = Trees.fit(np.array([r.f for r in rows], np.float32), np.array([r.weak for r in rows], np.float64))
    return model, [(r.origin, float(p), r.weak) for r, p in zip(rows, model.unseen) if r.origin is not None]


def scored(pages: DataFrame, model: Trees) -> DataFrame:
    """doc_id, origin and the trees' score."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array(b.column(2).flatten(), np.float32).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(shared.value.predict(x))], names=["doc_id", "origin", "score"])

    return pages.select("doc_id", "origin", "f").mapInArrow(run, "doc_id bigint, origin string, score double")


def odds(p):
    """Log odds of a probability (number, array or column), bounded."""
    if isinstance(p, Column):
        c = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
        return F.log(c / (1 - c))
    c = np.clip(p, CLIP, 1 - CLIP)
    return np.log(c / (1 - c))


def without_self(s, n, score, base):
    """The spam rate of a host without the page itself; the overall rate counts as HOST_PRIOR pages."""
    return (s - score + HOST_PRIOR * base) / (n - 1 + HOST_PRIOR)


def host_weight(hosts: DataFrame, base: float, sample: list[tuple[str, float, int]]) -> float:
    """The weight of the host's log odds that fits the labels of the training pages best beside the scores of trees that
    did not see them: least log loss with a weak pull to 0, by Newton's method. Rates come for hosts of the sample only."""
    if not sample:
        return 0.0
    spark = hosts.sparkSession
    wanted = spark.createDataFrame([(o,) for o in sorted({o for o, _, _ in sample})], "origin string")
    rates = {r.origin: (r.s, r.n) for r in hosts.join(F.broadcast(wanted), "origin").collect()}
    p, y = np.array([x[1] for x in sample]), np.array([x[2] for x in sample], float)
    s, n = (np.array([rates[o][i] for o, _, _ in sample], float) for i in (0, 1))
    shift = odds(without_self(s, n, p, base)) - odds(base)
    w = 0.0
    for _ in range(20):
        q = 1 / (1 + np.exp(-(odds(p) + w * shift)))
        w -= ((q - y) @ shift + w) / ((q * (1 - q)) @ shift**2 + 1.0)
    return float(np.clip(w, 0.0, 1.0))


def smoothed(scores: DataFrame, sample: list[tuple[str, float, int]]) -> DataFrame:
    """Adds `p`: the score with the log odds of its host's rate against the overall one, by the fitted weight. The rates are
    aggregated before they are joined, and each host's is repeated SALT times so that a host with most of the pages is
    spread over tasks."""
    hosts = written(scores.groupBy("origin").agg(F.sum("score").alias("s"), F.count("*").alias("n")), "spam-hosts")
    s, n = hosts.agg(F.sum("s"), F.sum("n")).first()
    base = s / n if n else 0.5
    weight = host_weight(hosts, base, sample)
    rates = hosts.filter("origin is not null").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    joined = scores.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).cast("int")).join(rates, ["origin", "salt"], "left")
    rate = without_self(F.col("s"), F.col("n"), F.col("score"), F.lit(base))
    shift = F.when(F.col("n").isNotNull(), F.lit(weight) * (odds(rate) - float(odds(base)))).otherwise(0.0)
    return joined.select("doc_id", "origin", "score", (1 / (1 + F.exp(-(odds(F.col("score")) + shift)))).alias("p"))


def spam_pages(docs: DataFrame) -> DataFrame:
    """doc_id, origin, score and p of every page with words or links."""
    pages = written(page_features(docs), "spam-features")
    model, sample = train(pages)
    return smoothed(written(scored(pages, model), "spam-scores"), sample)
