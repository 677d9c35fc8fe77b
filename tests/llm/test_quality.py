import random
import re
from collections import Counter

from modrisk.llm import quality


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)), "n_repeat_words": len(covered),
    }


def texts():
    draw = random.Random(8)
    vocabulary = ["a", "bb", "ccc", "é", "#x", "|", "don't", "日本"]
    out = [" ".join(draw.choice(vocabulary[: draw.choice([1, 2, 8])]) for _ in range(draw.randrange(60))) for _ in range(150)]
    out += ["\n".join(draw.choice(["x y", "x y ", "", " ", "z"]) for _ in range(12)) for _ in range(30)]
    return [*out, None, "", " \t\x0b\x0c\r\n ", "w " * 50_000, "y" * 200_000, out[0], out[0], "a\u00a0b\u2003c"]


def test_like_brute_force(spark):
    data = [(i, t, "clash") for i, t in enumerate(texts())]
    rows = quality.judge(spark.createDataFrame(data, "doc_id long, text string, n_words string")).collect()
    assert len(rows) == len(data)
    for r in rows:
        want = slow(data[r["doc_id"]][1])
        assert {k: r[k] for k in want} == want, data[r["doc_id"]][1]
        assert r["base_failed"] == (want["n_words"] < 20 or 100 * want["n_repeat_words"] > 30 * want["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_order_changes_no_verdict(spark, documents):
    rules = quality.default_rules()
    one = {r["doc_id"]: r["kept"] for r in quality.judge(documents, rules, sample_rows=0).collect()}
    other = {r["doc_id"]: r["kept"] for r in quality.judge(documents, rules[::-1], sample_rows=0).collect()}
    assert one == other
    assert {True, False} == set(one.values())
    order = quality.ordered_rules(documents, [quality.Rule("never", lambda d: False), quality.Rule("always", lambda d: True)])
    assert [r.name for r in order] == ["always", "never"]


def test_good_documents_stay(spark, sf, documents):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(documents).collect() if not r["base_failed"] or labels.get(r["doc_id"]) == 0}
    labels = {i: q for i, q in labels.items() if i in kept}
    good = [kept[i] for i, q in labels.items() if q == 1]
    bad = [kept[i] for i, q in labels.items() if q == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.3 * len(bad)


def test_odd_rows(spark, odd, nothing):
    rows = quality.judge(odd, carry=["text_sha256"]).collect()
    assert len(rows) == odd.count()
    assert quality.judge(nothing).count() == 0
