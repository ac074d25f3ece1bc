"""URL filter and vector operators against plain versions, the pipeline, and the query checks."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from samples import documents, prose

from carelake.llm import e8, lattice, onebit, url_filter
from carelake.llm.queries import URL_RULES

RULES = {r.text: (r.host, r.path, r.verdict) for r in URL_RULES}
URLS = [
    "https://A.Example.NET/en/1?x#y", "http://example.net/de/2", "ftp://sub.example.com/de/x", "x://example.com/de", "http://org/fr/",
    "http://a.org/fr/z", "http://borg/fr/", "http://net", "http://net/", "http://a.net?x=/", "no scheme", "", None, "://", "a://b://c/d",
    "http://ÄB.net/é", "http://host\n.net/p\nq#f", "https://" + "a" * 50_000 + ".net/" + "b" * 50_000,
    "https://best-casino-bonus.example.com/en/1", "https://wiki.garden.example.org/en/2",
]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fits = [t for t, (h, p, _) in RULES.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len) if fits else None


def test_url_rules_and_model(spark):
    pages = spark.createDataFrame([(i, u, "html", 1.0) for i, u in enumerate([*URLS, URLS[0]])] + [(None, URLS[0], None, None)],
                                  "page_id long, url string, html string, score double")
    got = url_filter.judge(pages, URL_RULES, url_filter.fit(url_filter.labelled_urls(spark))).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule = plain(URLS[0] if r["page_id"] in (None, len(URLS)) else URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (RULES[rule][2] if rule else "block" if r["score"] >= 0.5 else "allow")
    verdict = {r["page_id"]: r["verdict"] for r in got}
    assert verdict[18] == "block" and verdict[19] == "allow"


def test_url_model_after_an_observation(spark):
    """A session that has used an Observation cannot be serialized; no plan may hold it."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    pages = spark.createDataFrame([(1, URLS[-2]), (2, URLS[-1])], "page_id long, url string")
    model = url_filter.fit(url_filter.labelled_urls(spark))
    for frame in (pages, pages.limit(0)):
        url_filter.judge(frame, URL_RULES, model).write.format("noop").mode("overwrite").save()


def test_url_model_holds_out(spark):
    """Half of the table is to be blocked, and most of its words stand in one url only."""
    rows = list(url_filter.LABELLED)
    random.Random(1).shuffle(rows)
    right = 0
    for k in range(3):
        model = url_filter.fit(url_filter.labelled_urls(spark, tuple(rows[:k * 20] + rows[k * 20 + 20:])))
        pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows[k * 20:k * 20 + 20])], "page_id long, url string")
        got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages, (), model).collect()}
        right += sum((got[i] == "block") == bool(y) for i, (_, y) in enumerate(rows[k * 20:k * 20 + 20]))
    assert right >= 0.7 * 60


def vectors(spark, n=600, d=16, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    x[100:300] = x[0] + 0.12 * rng.standard_normal((200, d))
    x[300:340] = x[300]
    x[340:400] = x[340] * rng.uniform(0.5, 5, (60, 1)) + 0.3 * rng.standard_normal((60, d))
    rows = [(i, v.tolist(), 1, "k") for i, v in enumerate(x)]
    bad = [None, [], [0.0] * d, [float("nan")] * d, [float("inf")] + [1.0] * (d - 1), [None] + [1.0] * (d - 1)]
    rows += [(1000 + i, v, None, None) for i, v in enumerate(bad)] + [(2000, [1.0, 2.0], 1, "k"), (2001, [1.0, 2.1], 1, "k")]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, key string")


@pytest.mark.parametrize("block", [1024, 50])
def test_linked_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    x, table = vectors(spark)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r for r in lattice.near_duplicates(table).collect()}
    assert len(got) == 608
    links = np.array([got[i]["n_links"] for i in range(600)])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.97 * near.sum()
    component = np.arange(600)
    while True:
        low = np.minimum(component, np.where(near, component[None, :], 10**9).min(1))
        if (low == component).all():
            break
        component = low
    assert np.mean([got[i]["component_id"] == component[i] for i in range(600)]) > 0.99
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(1000, 1006))
    assert got[2000]["n_links"] == 1 and got[2001]["component_id"] == 2000 and not got[2001]["kept"]


def test_e8_decodes_to_the_nearest_point():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((200, 8)) * 2
    home = e8.decode(x)
    shell = e8.neighbours()
    assert len({tuple(v) for v in shell}) == 240 and ((shell**2).sum(1) == 8).all()
    away = ((2 * x[:, None, :] - home[:, None, :] - shell[None]) ** 2).sum(2).min(1)
    assert (((2 * x - home) ** 2).sum(1) <= away + 1e-9).all()


def test_search_finds_the_largest_inner_products(spark):
    x, table = vectors(spark, n=600)
    got = defaultdict(list)
    for r in onebit.search(table, table.vec_id % 20 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, 600, 20):
        score = x @ x[q]
        found = [v for _, v, _ in sorted(got[q])]
        assert len(found) == 20 and q not in found
        assert [k for k, _, _ in sorted(got[q])] == list(range(1, 21))
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in got[q])
        ranked = [(-s, v) for _, v, s in sorted(got[q])]
        assert ranked == sorted(ranked)
        best = [i for i in np.lexsort((np.arange(600), -score)) if i != q][:20]
        hits += len(set(best) & set(found))
    assert hits >= 0.9 * 600
    assert [v for _, v, _ in got[2000]] == [2001] and 1000 not in got


def test_empty_tables_give_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert lattice.near_duplicates(empty).count() == 0
    assert onebit.search(empty, empty.vec_id % 20 == 0).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(pages, URL_RULES, url_filter.fit(url_filter.labelled_urls(spark))).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    clean = [(i, prose(rng, 60)) for i in range(120)]
    toxic = [(200 + i, prose(rng, 20) + " you idiot zogmar " + prose(rng, 20)) for i in range(60)]
    copies = [(300 + i, clean[i][1] + " end") for i in range(20)]
    passage = prose(rng, 60)
    shared = [(400 + i, prose(rng, 70) + " " + passage) for i in range(4)]
    docs = documents(spark, [*clean, *toxic, *copies, *shared, (900, None), (901, "")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i >= 200)) for i, _ in [*clean, *toxic]], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "packing"]
    kept = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(kept)
        if name != "packing":
            assert kept.columns == docs.columns
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in seen]
    assert not ids[0] & {i for i, _ in toxic} and len(ids[0] & {i for i, _ in clean}) >= 115
    assert not {i + 300 for i in range(20) if i in ids[0]} & ids[1] and ids[1] >= ids[0] - {300 + i for i in range(20)}
    text = {r["doc_id"]: r["text"] for r in seen[2].collect()}
    assert sum(passage in (text[i] or "") for i in ids[1] if i >= 400 and i < 900) == 1
    assert ids[2] == ids[1] == ids[3]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(ids[3])


def test_queries_read_whole_tables(spark):
    from carelake.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    size = {t: spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("documents", "pages", "embeddings")}
    wanted = {1: "pages", 2: "embeddings", 10: None} | dict.fromkeys((3, 4, 5, 6, 7, 8, 9), "documents")
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    for name, query in QUERIES.items():
        table = wanted[int(name[2:].split("_")[0])]
        assert query(spark, sf).count() == (size[table] if table else 20 * size["embeddings"] // 20)
