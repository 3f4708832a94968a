"""Queries of §2.12 (BLEU part): 13a tokens, n-gram matches, corpus and grouped BLEU."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitext.operators import bleu as BL
from bitext.plans.catalog import query, r6
from bitext.sources import fixtures as X
from bitext.sources.tables import table


@query("bleu_tokenize")
def q_bleu_tokenize(spark, sf):
    return BL.tokenize(X.hyp_ref(spark, sf))


@query("ngram_matches")
def q_ngram_matches(spark, sf):
    return BL.ngram_matches(X.hyp_ref(spark, sf))


def _bleu_cols(d, by=()):
    return d.select(*by, r6("bleu").alias("bleu"), "sys_len", "ref_len",
                    *[f"m{n}" for n in range(1, 5)], *[f"t{n}" for n in range(1, 5)])


@query("corpus_bleu")
def q_corpus_bleu(spark, sf):
    return _bleu_cols(BL.corpus_bleu(X.hyp_ref(spark, sf)))


@query("grouped_bleu")
def q_grouped_bleu(spark, sf):
    """BLEU per document language (the pair's document decides the group)."""
    hr = X.hyp_ref(spark, sf).withColumn("doc_id", F.expr(f"pair_id div {X.PAIR_ID_STRIDE}"))
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    # the sums of a document meet its language, not the texts
    g = BL.corpus_sums(hr, by=["doc_id"]).join(docs, "doc_id")
    return _bleu_cols(BL.bleu_of_sums(BL.regrouped(g, by=["lang"])), ["lang"])
