"""Operator 5 against plain counts; labelled rows for the verdicts."""
import re
from collections import Counter

import numpy as np

import cases
from cases import SF
from kinlink.llm import iforest_rules as R, queries


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def check(rows, got):
    key = lambda x: (str(x[0]), *x[1:6])
    want = sorted(((i, *plain_counts(t)) for i, t, *_ in rows), key=key)
    got = sorted(map(tuple, got), key=key)
    assert [g[:6] for g in got] == want
    for g in got:
        failed = g[1] < 20 or 100 * g[5] > 30 * g[1]
        assert g[6] == failed and not (failed and g[7])


def test_awkward_rows(awkward, labels, no_labels):
    rows = cases.awkward()
    check(rows, R.quality_rules(awkward, labels).collect())
    got = R.quality_rules(awkward, no_labels).collect()
    check(rows, got)
    assert all(r.kept == (not r.base_failed) for r in got)
    kept = R.keep_quality(awkward, no_labels)
    assert kept.columns == awkward.columns and kept.count() == sum(r.kept for r in got)


def test_empty(empty, labels):
    assert R.quality_rules(empty, labels).collect() == [] and R.keep_quality(empty, labels).collect() == []


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, queries.op5_quality_rules(spark, SF).collect())


def test_verdicts_follow_the_labels(spark):
    sf = SF.replace("0.001", "0.01")
    got = {r.doc_id: r for r in queries.op5_quality_rules(spark, sf).collect()}
    labelled = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [got[r.doc_id].kept for r in labelled if r.quality and not got[r.doc_id].base_failed]
    poor = [got[r.doc_id].kept for r in labelled if not r.quality]
    assert np.mean(good) > 0.98 and np.mean(poor) < 0.3


def test_forest_isolates_what_is_rare():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (500, 3)), [[9, 9, 9]]])
    score = R.IsolationForest(x, 100, 64).score(x)
    assert score[-1] > score[:-1].max()
    assert R.threshold(np.arange(100.), np.arange(100) < 90, 0.0) == 89


def test_one_mislabelled_row_does_not_switch_a_forest_off():
    good = np.append(np.arange(300) < 200, True)
    scores = np.append(np.arange(300.), 1000.)
    assert R.threshold(scores, good, 0.001) == 199
    assert R.threshold(-scores, good, 0.001) == float("inf")      # poor rows score lower: nothing to reject


def test_limits_come_from_all_labelled_rows(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{x}.parquet") for x in ("documents", "labels"))
    rules = R.fit(docs, labels, max_labelled=40)
    label = {r[0]: r[1] > 0 for r in R.consistent(labels, "quality").collect()}
    rows = [(label[i], R.rule_counts(t)) for i, t in docs.select("doc_id", "text").collect() if i in label]
    good, counts = np.array([g for g, _ in rows]), np.array([c for _, c in rows])
    judged = ~R.base_failed(counts[:, 0], counts[:, 4])
    assert judged.sum() > 100
    got = R.steps(rules.scores(counts[judged]))
    for k, name in enumerate(R.GROUPS):
        assert rules.limits[name] == R.threshold(got[:, k], good[judged], 0.001), name
    assert R.features(np.array([[30, 150, 0, 0, 0, 0, 0, 0], [9000, 150, 0, 0, 0, 0, 0, 0]])).std(axis=0)[R.GROUPS["length"]].min() > 0
