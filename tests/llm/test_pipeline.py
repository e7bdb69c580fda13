"""Every stage of the pipeline against a brute-force version on the given tables, and the registered queries."""

import re
from collections import Counter, defaultdict
from html import unescape
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from segmill.llm import patience, quality, queries, secrets

from .brute import brute_classes, brute_nearest, brute_repeats, filled

SF = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input of every stage and the result of the last, each written and read again."""
    root = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(docs.toPandas())
        stage(spark, docs, SF).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == DOCUMENTS
    return [*out, docs.toPandas()]


def test_quality_stage_keeps_what_the_forest_scores_high(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    forest = quality.fit(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    x = np.array([quality.statistics(t) for t in steps[0]["text"]])
    assert set(steps[1]["doc_id"]) == set(steps[0]["doc_id"][forest.score(x) >= 0.7])
    marked = labels.toPandas().set_index("doc_id")["quality"]
    lost = set(steps[0]["doc_id"]) - set(steps[1]["doc_id"])
    assert all(marked.get(i, 0) == 0 for i in lost)


def test_near_duplicate_stage_keeps_the_first_of_each_class(steps):
    texts, ids = list(steps[1]["text"]), list(steps[1]["doc_id"])
    assert set(steps[2]["doc_id"]) == {min(ids[i] for i in g) for g in brute_classes(texts)}


def test_decontamination_stage_drops_documents_with_items(spark, steps):
    items = [re.findall(r"[^\W\d_]+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    lost = set(steps[2]["doc_id"]) - set(steps[3]["doc_id"])
    for doc_id, text in zip(steps[2]["doc_id"], steps[2]["text"], strict=True):
        words = " ".join(re.findall(r"[^\W\d_]+", text.lower()))
        whole = any(" ".join(w) in words for w in items)
        none = not any(" ".join(w[i : i + 6]) in words for w in items for i in range(len(w) - 5))
        assert (doc_id in lost) if whole else True
        assert (doc_id not in lost) if none else True


def test_secret_stage_leaves_no_fixed_pattern_and_every_document(steps):
    assert list(sorted(steps[4]["doc_id"])) == list(sorted(steps[3]["doc_id"]))
    before = dict(zip(steps[3]["doc_id"], steps[3]["text"], strict=True))
    for doc_id, text, n in zip(steps[4]["doc_id"], steps[4]["text"], steps[4]["n_chars"], strict=True):
        assert n == len(text)
        assert not secrets.base_spans(text.replace("[SECRET]", " "))
        if not secrets.base_spans(before[doc_id]) and not secrets.candidates(before[doc_id], []):
            assert text == before[doc_id]


def test_mixing_stage_meets_the_targets(steps):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    given, mixed = steps[4], steps[5]
    sizes, largest = Counter(), Counter()
    for s, t in zip(given["source"], given["text"], strict=True):
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    order = sorted(sizes, key=str.encode)
    expected = dict(zip(order, filled([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))]), strict=True))
    taken = Counter()
    for r in mixed.itertuples():
        assert r.taken == r.size * r.repeats == size(r.text) * r.repeats and 1 <= r.repeats <= 3
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= largest[s] / 2 + 1e-6 for s in order)


def test_run_gives_the_same_as_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert Counter(zip(got["doc_id"], got["taken"], strict=True)) == Counter(zip(steps[5]["doc_id"], steps[5]["taken"], strict=True))


def test_stages_take_empty_and_odd_tables(spark):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (odd, odd.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() <= docs.count()


def test_stages_keep_columns_called_like_results(spark):
    extra = ["row_no", "class_key", "spans", "base", "row", "key", "score", "n_random", "tokens"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(f"kept {c}") for c in extra})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.select(*extra).distinct().collect() == [tuple(f"kept {c}" for c in extra)]


def test_queries_are_registered():
    names = set(queries.queries())
    assert names <= set(contract.queries()) and "pipeline" in names
    assert {re.match(r"op(\d+)_", n)[1] for n in names - {"pipeline"}} == {str(i) for i in range(1, 14)}


# The registered queries against brute force on whole tables


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").toPandas()


def rows(spark, name):
    return queries.queries()[name](spark, SF).collect()


def test_op1(spark, documents):
    known = patience.templates()
    expected = Counter((i, *f) for i, t in zip(documents["doc_id"], documents["text"], strict=True) for f in patience.find_licenses(t, known))
    assert Counter(tuple(r) for r in rows(spark, "op1_licenses")) == expected and expected


def test_op2(spark, documents):
    got = {r["doc_id"]: r for r in rows(spark, "op2_secrets")}
    assert len(got) == len(documents)
    for i, t in zip(documents["doc_id"], documents["text"], strict=True):
        spans = secrets.base_spans(t)
        assert [got[i][c] for c in ("n_assign", "n_access", "n_hex")] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        assert {f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans} <= set(got[i]["spans"].split(",")) | {""}


def test_op3(spark, documents):
    groups = defaultdict(set)
    for r in rows(spark, "op3_near_duplicates"):
        groups[r["class_id"]].add(r["doc_id"])
    ids = list(documents["doc_id"])
    assert {frozenset(g) for g in groups.values()} == {frozenset(ids[i] for i in g) for g in brute_classes(list(documents["text"]))}
    assert all(min(g) == c for c, g in groups.items())


def test_op4_rows_point_at_items(spark):
    assert all(r["coverage"] >= 0.5 and r["n_windows"] <= r["item_windows"] for r in rows(spark, "op4_decontamination"))


def test_op5(spark):
    """The given pages have one article each, without zones in it: its text between the tags of blocks."""
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    expected = {}
    for p in pages:
        inner = re.split("</article>|<footer", p["html"].split("<article>")[1])[0]
        blocks = [" ".join(unescape(re.sub("<br>", " ", b)).split()) for b in re.split(r"</?(?:h1|p|ul|li)>", re.sub("</?b>", "", inner))]
        expected[p["page_id"]] = "\n".join(b for b in blocks if b)
    got = rows(spark, "op5_html_text")
    assert {r["page_id"]: r["text"] for r in got} == expected and len(got) == len(pages)
    assert all(len(r["text"]) == r["n_chars"] for r in got)


@pytest.mark.parametrize("name", ["op6_quality", "op10_toxicity"])
def test_scores(spark, documents, name):
    got = rows(spark, name)
    least = 0.7 if name == "op6_quality" else 0.3
    assert Counter(r["doc_id"] for r in got) == Counter(documents["doc_id"])
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= least) for r in got)


def test_op7(spark, documents):
    got = sorted((tuple(r) for r in rows(spark, "op7_long_matches")), key=lambda r: r[0])
    assert [r[1:] for r in got] == brute_repeats(list(documents["text"]), 200)


def test_op8(spark, documents):
    got = rows(spark, "op8_mixing")
    assert Counter(r["doc_id"] for r in got) == Counter(documents["doc_id"])
    assert sum(r["size"] for r in got) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in documents["text"])


def test_op9_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>")).collect()
    truth = brute_nearest([(i, list(v)) for i, v in table])
    got = defaultdict(set)
    for r in rows(spark, "op9_nearest_vectors"):
        got[r["query_id"]].add(r["vec_id"])
    assert np.mean([len(got[q] & set(t)) / 5 for q, t in truth.items()]) >= 0.9


def test_nothing_of_the_rest_imports_these_modules():
    root = Path(contract.__file__).parent
    rest = [f for f in (root / "segmill").rglob("*.py") if "llm" not in f.parts] + [root / "bench.py", *(root / "tests").glob("*.py")]
    assert len(rest) > 20 and not [f for f in rest if re.search(r"^\s*(from|import) segmill\.llm|corpus_pipeline", f.read_text(), re.MULTILINE)]
    guarded = (root / "__spark_entry__.py").read_text()
    assert len(re.findall("segmill.llm import", guarded)) == 1 and "corpus_pipeline" not in guarded


@pytest.mark.parametrize("name", ["op4_decontamination", "op8_mixing"])
def test_native_queries_run_no_python(spark, name):
    out = queries.queries()[name](spark, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|PythonRDD|ExternalRDD", plan)
