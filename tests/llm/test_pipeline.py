import hashlib

import corpus_pipeline
from bitext.llm import bytebpe, decontam, quality, queries, secrets, simhash

SF = "/root/testdata/sf0.001"


def test_stage_names_and_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_run_equals_stages_by_hand(spark):
    """Each stage redone on plain Python rows from the operators' full-table results."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r["predicted"]}
    first = docs.where(docs.doc_id.isin(sorted(good)))
    near = {r["doc_id"]: int(r["fingerprint"], 16) for r in simhash.near_duplicates(first).collect()}
    left = set()
    root = {}
    for a in sorted(near):
        if a not in root:
            todo, root[a] = [a], a
            while todo:
                x = todo.pop()
                for y in near:
                    if y not in root and bin(near[x] ^ near[y]).count("1") <= 4:
                        root[y] = a
                        todo.append(y)
            left.add(a)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    finder = decontam.Finder(items)
    left = {i for i in left if not finder.find(text[i])}
    with open(corpus_pipeline.public_tokenizers.path(corpus_pipeline.VOCAB), "rb") as f:
        ranks = bytebpe.read_ranks(f.read())
    scanner = secrets.Scanner(ranks, corpus_pipeline.public_tokenizers.PATTERN)
    want = {i: hashlib.sha256(secrets.mask(text[i], scanner.scan(text[i])[1]).encode()).hexdigest() for i in left}
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want and 0 < len(got) < len(text)


def test_stages_take_empty_and_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(1, None, None, None, None, 1.0), (2, "", "en", "s", 0, None), (2, "", "en", "s", 0, None), (None, "password=abcdef1 " * 9, "en", "s", 5, 0.0), (4, "w " * 40_000, "de", "s", 80_000, 0.5)]
    for table in (spark.createDataFrame([], schema), spark.createDataFrame(rows, schema)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SF)
            assert out.columns == table.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, table, SF).collect()


def test_every_query_is_registered():
    names = set(queries.QUERIES)
    assert "pipeline" in names and {n.split("_")[0] for n in names} - {"pipeline"} == {f"op{i}" for i in range(1, 11)}
