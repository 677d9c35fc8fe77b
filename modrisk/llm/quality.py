"""Quality rules as a short-circuit cascade.

Every rule looks at one text. On a bounded sample each rule's cost (seconds a document) and rejection rate are measured;
the rules then run in the order of rejections per second, and a document leaves the cascade at its first rejection. The
order changes the time only: the verdict is "no rule rejects", whatever the order.

The base counts are part of the result, so they are taken for every document, outside the cascade.

Defined results: a null text counts as empty; a text with no words fails the base rule (under ``min_words``). Rows that
repeat are judged each by itself. No row is dropped and none is added. Other columns may be passed through with
``carry``; a carried column must not have the name of a result column.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from modrisk.llm.shared import numbered, renamed

SAMPLE_ROWS = 500  # texts that cost and selectivity are measured on
SAMPLE_CHARS = 20_000  # length of the longest of them
ROWS_AT_ONCE = 256
WINDOW = 8  # words in a window that counts as repeated
_BLANKS = re.compile(r"[\x20\x09-\x0D]")
_SYMBOLS = re.compile(r"[#*$%&|<>]")
_SPLIT = re.compile(r"[\x20\x09-\x0D]+")

_rng = np.random.default_rng(20240501)
_FACTORS = _rng.integers(1, 2**63, size=WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str) -> list[str]:
    return [w for w in _SPLIT.split(text) if w]


def _mixed(ids: np.ndarray) -> np.ndarray:
    """64 well-spread bits for each small integer."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """Words inside windows whose word sequence is found twice or more, the first place included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    spread = _mixed(ids)
    keys = np.zeros(n, np.uint64)
    for k in range(window):
        keys += spread[k : k + n] * _FACTORS[k]
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    # Equal keys count only if the words are equal too.
    first, second = order[:-1][same], order[1:][same]
    for k in range(window):
        alike = ids[first + k] == ids[second + k]
        first, second = first[alike], second[alike]
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.unique(np.concatenate([first, second]))
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


@dataclass
class Doc:
    """A text with its words, and the counts that several rules share."""

    text: str
    words: list[str] = field(default_factory=list)
    word_chars: int = 0
    n_symbols: int = 0
    n_lines: int = 0
    n_dup_lines: int = 0
    n_repeat_words: int = 0


def looked_at(text: str | None) -> Doc:
    doc = Doc(text or "")
    doc.words = words_of(doc.text)
    doc.word_chars = len(doc.text) - len(_BLANKS.findall(doc.text))
    doc.n_symbols = len(_SYMBOLS.findall(doc.text))
    earlier: set[str] = set()
    for line in doc.text.split("\n"):
        if _SPLIT.sub("", line):
            doc.n_lines += 1
            doc.n_dup_lines += line in earlier
            earlier.add(line)
    doc.n_repeat_words = repeated_words(doc.words)
    return doc


def base_failed(doc: Doc, min_words: int = 20, repeat_percent: int = 30) -> bool:
    n = len(doc.words)
    return n < min_words or 100 * doc.n_repeat_words > repeat_percent * n


@dataclass(frozen=True)
class Rule:
    """``rejects`` says whether a document is junk; it must not depend on other rules."""

    name: str
    rejects: Callable[[Doc], bool]


def default_rules() -> list[Rule]:
    """Rules on junk that ordinary prose does not come near to; integer arithmetic, so no rounding decides."""
    return [
        Rule("word_length", lambda d: not 2 * len(d.words) <= d.word_chars <= 20 * len(d.words)),
        Rule("symbols", lambda d: 100 * d.n_symbols > 25 * len(d.words)),
        Rule("repeated_lines", lambda d: 100 * d.n_dup_lines > 50 * d.n_lines),
        Rule("shouting", lambda d: 100 * d.text.count("!") > 50 * len(d.words)),
        Rule("stuttering", lambda d: 100 * sum(a == b for a, b in zip(d.words, d.words[1:], strict=False)) > 20 * len(d.words)),
        Rule("few_letters", lambda d: 100 * sum(any(c.isalpha() for c in w) for w in d.words) < 60 * len(d.words)),
    ]


def ordered_rules(
    docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS
) -> list[Rule]:
    """The rules by rejections per second on a bounded sample; ties keep the given order.

    The sample is at most ``sample_rows`` texts of at most ``sample_chars`` characters, taken from the first partitions that have
    them, and measured on the driver.
    """
    text = F.col(text_col).cast("string").alias("text")
    spent, rejected = [0.0] * len(rules), [0] * len(rules)
    for row in docs.select(text).filter(F.length("text") <= sample_chars).take(sample_rows):
        doc = looked_at(row["text"])
        for i, rule in enumerate(rules):
            began = time.perf_counter()
            rejected[i] += rule.rejects(doc)
            spent[i] += time.perf_counter() - began
    gain = {rule.name: n / max(s, 1e-9) for rule, n, s in zip(rules, rejected, spent, strict=True)}
    return sorted(rules, key=lambda rule: gain[rule.name], reverse=True)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def judge(
    docs: DataFrame,
    rules: list[Rule] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: list[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per input row: id, the base counts, base_failed, kept, rejected_by (first rule of the cascade)."""
    chosen = ordered_rules(docs, default_rules() if rules is None else rules, text_col, sample_rows)
    extra = [c for c in carry or [] if c != id_col]
    frame = docs.select(F.col(id_col), *[F.col(c) for c in extra], F.col(text_col).cast("string").alias("_text"))
    schema = ", ".join(
        [f"`{n}` {t}" for n, t in frame.drop("_text").dtypes]
        + [f"{c} long" for c in COUNTS]
        + ["base_failed boolean", "kept boolean", "rejected_by string"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A few rows at a time: their word lists take many times the room of the texts.
        for batch in (whole.slice(at, ROWS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
            docs = [looked_at(t) for t in batch.column("_text").to_pylist()]
            failed = [base_failed(d) for d in docs]
            by: list[str | None] = [None] * len(docs)
            alive = [i for i, bad in enumerate(failed) if not bad]
            for rule in chosen:
                rest = []
                for i in alive:
                    if rule.rejects(docs[i]):
                        by[i] = rule.name
                    else:
                        rest.append(i)
                alive = rest
            kept = np.zeros(len(docs), bool)
            kept[alive] = True
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [
                pa.array([len(d.words) for d in docs], pa.int64()),
                *[pa.array([getattr(d, c) for d in docs], pa.int64()) for c in COUNTS[1:]],
                pa.array(failed, pa.bool_()), pa.array(kept), pa.array(by, pa.string()),
            ]
            names = batch.schema.names[:-1] + COUNTS + ["base_failed", "kept", "rejected_by"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return frame.mapInArrow(run, schema)


def keep_good(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that no rule rejects, with all their columns, whatever their names."""
    rows, at = numbered(docs)
    return renamed(judge(rows, rules, at[id_col], at[text_col], carry=rows.columns).filter("kept"), docs)
