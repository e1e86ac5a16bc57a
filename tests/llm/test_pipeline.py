import hashlib
import re
from collections import Counter

import pytest

import corpus_pipeline
from clinspark.llm import simhash

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Rows of documents and of every stage's output, each stage written and read again."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs.collect()]
    columns = [docs.columns]
    for i, (_, function) in enumerate(corpus_pipeline.STAGES):
        function(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        found.append(docs.collect())
        columns.append(docs.columns)
    assert all(c == columns[0] for c in columns[:-1])
    return found


def test_quality_rejects_the_poor_and_keeps_the_good(steps, spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in steps[1]}
    assert kept < {r["doc_id"] for r in steps[0]}
    good = [i for i, q in labels.items() if q == 1]
    poor = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) / len(good) > 0.95
    assert sum(i in kept for i in poor) / len(poor) < 0.2
    given = {r["doc_id"]: r for r in steps[0]}
    assert all(r == given[r["doc_id"]] for r in steps[1])


def test_one_row_of_equal_texts_stays(steps):
    first = {}
    for r in steps[1]:
        key = norm(r["text"])
        first[key] = min(first.get(key, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in steps[2]) == sorted(first.values())


def test_one_row_of_near_texts_stays(steps):
    rows = sorted(steps[2], key=lambda r: r["doc_id"])
    fps = [simhash.fingerprint(r["text"]) for r in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    wanted = [rows[i]["doc_id"] for i in range(len(rows)) if find(i) == i]
    assert sorted(r["doc_id"] for r in steps[3]) == wanted


def test_sources_meet_their_targets(steps):
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in steps[3]}
    source = {r["doc_id"]: r["source"] for r in steps[3]}
    words = Counter()
    for i, n in size.items():
        words[source[i]] += n
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(words))}
    left, open_, target = float(sum(words.values())), set(words), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * words[s]}
        target |= {s: 3.0 * words[s] for s in over} or {s: left * weight[s] / total for s in open_}
        left -= sum(3 * words[s] for s in over)
        open_ = open_ - over if over else set()
    copies = Counter(r["doc_id"] for r in steps[4])
    assert max(copies.values()) <= 3
    taken = Counter()
    for i, n in copies.items():
        taken[source[i]] += n * size[i]
    for s in words:
        assert abs(taken[s] - target[s]) <= max(size[i] for i in size if source[i] == s)


def test_every_copy_is_encoded_and_decoded(steps):
    import sentencepiece

    tool = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = Counter()
    for r in steps[4]:
        ids = tool.encode(r["text"] or "", add_eos=True)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        wanted[r["doc_id"], len(ids), digest(" ".join(map(str, ids))), digest(tool.decode(ids))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in steps[5]) == wanted


def test_run_gives_the_rows_of_the_last_stage(steps, spark):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[-1]))


def folder_of(spark, tmp_path, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_empty_tables(spark, tmp_path):
    folder = folder_of(spark, tmp_path, spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_nulls_repeated_rows_and_clashing_columns(spark, tmp_path):
    rows = [
        (1, "one text with words enough to tell", "en", "a", None),
        (1, "one text with words enough to tell", "en", "a", None),
        (2, None, None, None, 3),
        (3, "", "en", "a", 0),
        (None, "a text without any id", None, "b", 1),
        (4, "long " * 50_000, "en", "b", 5),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("label", "size", "gone", "fp", "key", "copies", "ids"):
        docs = docs.selectExpr("*", f"'{name}!' as `{name}`")
    folder = folder_of(spark, tmp_path, docs, spark.createDataFrame([(1, None, 0), (None, 1, 0)], LABELS))
    current = docs
    for _, function in corpus_pipeline.STAGES[:-1]:
        current = function(spark, current, folder)
        assert current.columns == docs.columns
        assert all(r["gone"] == "gone!" for r in current.collect())
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in found} <= {1, 2, 3, 4, None}
    assert {1, 4, None} <= {r["doc_id"] for r in found}
