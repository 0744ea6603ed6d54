import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import site_quality as Q
from llm.conftest import EDGE_TEXTS

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_clean_documents_stay(spark, sf):
    folder = sf.replace("0.001", "0.1")
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.score_quality(documents, labels).filter("held_out").join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.2


def brute(rows, rate, of_sites, of_paths):
    """Rates of every row without itself, from (site, path, p)."""
    out = []
    for i, (s, t, _) in enumerate(rows):
        site = [p for j, (a, _, p) in enumerate(rows) if j != i and a == s]
        path = [p for j, (a, b, p) in enumerate(rows) if j != i and a == s and b == t]
        of_site = (sum(site) + of_sites * rate) / (len(site) + of_sites)
        out.append((of_site, (sum(path) + of_paths * of_site) / (len(path) + of_paths)))
    return out


def brute_components(rows):
    p = np.array([r[2] for r in rows])
    n, rate = len(p), p.mean()
    keys = {1: [r[0] for r in rows], 2: [(r[0], r[1]) for r in rows]}

    def groups(level):
        return {k: p[[x == k for x in keys[level]]] for k in set(keys[level])}

    sites, paths = groups(1), groups(2)
    inside = sum(((g - g.mean()) ** 2).sum() for g in sites.values()) / (n - len(sites))
    between = sum(len(g) * (g.mean() - rate) ** 2 for g in sites.values()) - (len(sites) - 1) * inside
    between /= n - sum(len(g) ** 2 for g in sites.values()) / n
    inside2 = sum(((g - g.mean()) ** 2).sum() for g in paths.values()) / (n - len(paths))
    between2 = sum(len(g) * (g.mean() - sites[k[0]].mean()) ** 2 for k, g in paths.items()) - (len(paths) - len(sites)) * inside2
    between2 /= n - sum(len(g) ** 2 / len(sites[k[0]]) for k, g in paths.items())
    return rate, Q.strength(inside, between), Q.strength(inside2, between2)


def test_rates_agree_with_brute_force(spark, docs, noise):
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for i in range(200):
        site = ["a", "b", "c", None][i % 4]
        junk = rng.random() < {"a": 0.1, "b": 0.6, "c": 0.3, None: 0.5}[site]
        words = noise(40, i)
        texts.append((i, " ".join(w + "***" for w in words) if junk else " ".join(words) + ".", site))
        labels.append((i, int(not junk), 0))
    df = docs(texts).withColumn("lang", F.when(F.col("doc_id") % 8 < 4, "x").otherwise(F.when(F.col("doc_id") % 3 == 0, "y")))
    got = sorted(Q.score_quality(df, spark.createDataFrame(labels, LABELS)).collect())
    where = {r["doc_id"]: (r["source"], r["lang"]) for r in df.collect()}
    rows = [(*where[r["doc_id"]], 1 / (1 + math.exp(-r["evidence"]))) for r in got]
    rate, of_sites, of_paths = brute_components(rows)
    for r, (site, path) in zip(got, brute(rows, rate, of_sites, of_paths)):
        assert r["site_rate"] == pytest.approx(site, abs=1e-9) and r["path_rate"] == pytest.approx(path, abs=1e-9)


def test_sparse_sites_shrink_and_large_ones_speak(spark, docs, noise):
    rows = [(i, " ".join(noise(30, i)), "good") for i in range(300)]
    rows += [(1000 + i, " ".join(w + "%%%" for w in noise(30, i)), "bad") for i in range(300)]
    rows += [(2000, " ".join(noise(30, 5)), "single")]
    labels = [(i, 1, 0) for i in range(300)] + [(1000 + i, 0, 0) for i in range(300)]
    got = {r["doc_id"]: r for r in Q.score_quality(docs(rows), spark.createDataFrame(labels, LABELS)).collect()}
    assert got[5]["site_rate"] > 0.9 and got[1005]["site_rate"] < 0.1
    assert 0.4 < got[2000]["site_rate"] < 0.6


def test_edge_rows_labels_urls_and_empty_table(spark, docs):
    df = docs([*[(i, t, None) for i, t in enumerate(EDGE_TEXTS)], (None, "a b", "s"), (3, "a b", "s")])
    df = df.withColumnRenamed("n_chars", "evidence")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (None, 1, 1), (2, None, None), (3, 0, 0)], LABELS)
    for given in (labels, labels.limit(0)):
        got = Q.score_quality(df, given).collect()
        assert len(got) == len(EDGE_TEXTS) + 2
        assert all(0 <= r["score"] <= 1 for r in got)
    assert Q.score_quality(docs([]), labels).count() == 0
    assert Q.keep_good(df, labels).columns == df.columns
    url = spark.createDataFrame([("https://Ab.example/x/y?q", "")], "url string, e string")
    assert tuple(url.select(Q.url_site(F.col("url")), Q.url_path(F.col("url"))).first()) == ("ab.example", "x")
