"""Quality rules as a short-circuit cascade.

Every rule is a test on one document that may reject it. On a sample of a few
files' rows the workers time each rule and each measure that rules share (words,
their hashes, ...) apart, and count which rules reject a document together. The
next rule is always the one that rejects most of the documents still left per
second, where measures that earlier rules took cost nothing. A document leaves at
its first failure. The order changes the time, never the verdict.

Defined results: null text counts as empty and is rejected (no words); copies
and repeated ids are judged as rows of their own; an empty table gives no rows;
``filter_documents`` keeps every input column, whatever its name.
"""
from __future__ import annotations

import random
import time
from collections import Counter, defaultdict
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, map_texts, record_batch, slices, text_of

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean")


class View:
    """One text; measures are taken when a rule first asks for them."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def data(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - (len(self.data) - len(self.data.translate(None, SPACE)))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def n_dup_lines(self) -> int:
        lines = [x for x in self.data.split(b"\n") if x.strip(SPACE)]
        return len(lines) - len(set(lines))

    @cached_property
    def word_ids(self) -> np.ndarray:
        return np.fromiter(map(hash, self.words), np.int64, self.n_words).view(np.uint64)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that some window of 8 covers which the text holds twice or more."""
        n = self.n_words - WINDOW + 1
        if n < 2:
            return 0
        ids = self.word_ids
        windows = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(WINDOW):
                windows = (windows + ids[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
                windows ^= windows >> np.uint64(29)
        ordered = np.sort(windows)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return 0
        edge = np.zeros(self.n_words + 1, np.int64)
        at = np.flatnonzero(np.isin(windows, twice))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
        return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def few_words(v: View) -> bool:
    return v.n_words < 20


def repeated_windows(v: View) -> bool:
    return 100 * v.n_repeat_words > 30 * v.n_words


def symbol_noise(v: View) -> bool:
    return 10 * v.n_symbols > 3 * v.n_words


def shouting(v: View) -> bool:
    """More than half of the words in capitals."""
    return 2 * sum(map(bytes.isupper, v.words)) > v.n_words


def stutter(v: View) -> bool:
    """More than a third of the words equal the word before."""
    ids = v.word_ids
    return 3 * int(np.count_nonzero(ids[1:] == ids[:-1])) > v.n_words


def word_length(v: View) -> bool:
    return v.n_words > 0 and not 2 * v.n_words <= v.word_chars <= 15 * v.n_words


Rule = Callable[[View], bool]
BASE_RULES: tuple[Rule, ...] = (few_words, repeated_windows)
RULES: tuple[Rule, ...] = (*BASE_RULES, symbol_noise, shouting, stutter, word_length)


def rejects(text: str, rules) -> bool:
    view = View(text)
    return any(rule(view) for rule in rules)


class TimedView(View):
    """A view that notes the seconds each measure takes by itself, without the
    measures that it asks for."""

    def __init__(self, text: str):
        super().__init__(text)
        self.seconds: dict[str, float] = {}
        self._inner = 0.0


def _timed(name: str) -> property:
    compute = vars(View)[name].func

    def get(self):
        values = self.__dict__
        if name not in self.seconds:
            outer, self._inner = self._inner, 0.0
            began = time.perf_counter()
            values[f"_{name}"] = compute(self)
            took = time.perf_counter() - began
            self.seconds[name] = took - self._inner
            self._inner = outer + took
        return values[f"_{name}"]

    return property(get)


for _name in [n for n, v in vars(View).items() if isinstance(v, cached_property)]:
    setattr(TimedView, _name, _timed(_name))


def best_order(masks: dict[str, int], own: list[float], needs: list[set[str]], cost: dict[str, float]) -> list[int]:
    """Numbers of rules, the one with most rejections per second first, and so on
    among the documents left. ``masks`` counts documents by which rules reject
    them (a "1" at the rule's place), ``own`` has each rule's seconds without
    measures, ``needs`` its measures, ``cost`` their seconds."""
    left, known, order = dict(masks), set(), []

    def worth(k: int) -> tuple[float, float]:
        price = own[k] + sum(cost.get(x, 0.0) for x in needs[k] - known)
        return sum(n for m, n in left.items() if m[k] == "1") / max(price, 1e-9), -price

    while len(order) < len(own):
        best = max((k for k in range(len(own)) if k not in order), key=worth)
        order.append(best)
        known |= needs[best]
        left = {m: n for m, n in left.items() if m[best] == "0"}
    return order


def sample_of(df: DataFrame, files: int, seed: int) -> DataFrame:
    """Texts to time the rules on: those of at most ``files`` Parquet files that
    ``df`` reads, chosen at random, as they lie there; the others are not opened.
    ``df`` itself where it reads no more files, other formats or further tables."""
    paths = sorted(df.inputFiles())
    if len(paths) <= files or not all(p.endswith(".parquet") for p in paths):
        return df
    found = df.sparkSession.read.parquet(*random.Random(seed).sample(paths, files))
    return found if "text" in found.columns else df


def cascade_order(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000,
                  seed: int = 7, sample_files: int = 4) -> list[Rule]:
    """``rules`` in the order of ``best_order``, from at most ``sample_files`` files
    and, in each of their splits, at most ``sample_rows / sample_files`` rows, after
    which a task stops reading. Only sums reach the driver: one row for each set of
    rules that some document breaks and for each rule and measure."""
    share = max(1, sample_rows // sample_files)
    schema = "rule int, name string, seconds double, times long"

    def measure(batches):
        seconds, times, seen = defaultdict(float), Counter(), 0
        for part in slices(batches):
            for text in part.column(0).to_pylist()[:share - seen]:
                seen += 1
                mask = ""
                for k, rule in enumerate(rules):
                    view = TimedView(text)
                    began = time.perf_counter()
                    mask += str(int(rule(view)))
                    took = time.perf_counter() - began
                    for name, spent in (*view.seconds.items(), ("", took - sum(view.seconds.values()))):
                        seconds[k, name] += spent
                        times[k, name] += 1
                times[-1, mask] += 1
            if seen == share:
                break
        keys = list(times)
        yield record_batch(schema, {"rule": [k for k, _ in keys], "name": [n for _, n in keys],
                                    "seconds": [seconds[k] for k in keys], "times": [times[k] for k in keys]})

    found = (sample_of(df, sample_files, seed).select(text_of().alias("text")).mapInArrow(measure, schema)
             .groupBy("rule", "name").agg(F.sum("seconds").alias("seconds"), F.sum("times").alias("times")).collect())
    masks = {r["name"]: r["times"] for r in found if r["rule"] < 0}
    if not masks:
        return list(rules)
    own, needs, spent, taken = [0.0] * len(rules), [set() for _ in rules], defaultdict(float), Counter()
    for r in found:
        if r["rule"] >= 0 and r["name"]:
            needs[r["rule"]].add(r["name"])
            spent[r["name"]] += r["seconds"]
            taken[r["name"]] += r["times"]
        elif r["rule"] >= 0:
            own[r["rule"]] = r["seconds"] / r["times"]
    return [rules[k] for k in best_order(masks, own, needs, {n: spent[n] / taken[n] for n in spent})]


def judge_documents(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """doc_id, the base measures, ``base_failed`` and the cascade's ``kept``."""
    order = cascade_order(df, rules, sample_rows)

    def kernel(texts):
        views = [View(t) for t in texts]
        failed = [any(rule(v) for rule in BASE_RULES) for v in views]
        return {"n_words": [v.n_words for v in views], "word_chars": [v.word_chars for v in views],
                "n_symbols": [v.n_symbols for v in views], "n_dup_lines": [v.n_dup_lines for v in views],
                "n_repeat_words": [v.n_repeat_words for v in views], "base_failed": failed,
                "kept": [not f and not any(rule(v) for rule in order) for f, v in zip(failed, views)]}

    return map_texts(df, kernel, SCHEMA)


def filter_documents(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The rows of ``df`` that no rule rejects, with all their columns."""
    order = cascade_order(df, rules, sample_rows)
    at = df.columns.index("text")

    def run(batches):
        for part in slices(batches):
            keep = [not rejects(t or "", order) for t in part.column(at).to_pylist()]
            yield part.filter(pa.array(keep, type=pa.bool_()))

    return map_rows(df, run)
