import brute
from conftest import SF

from gleaner.llm.quality_divergence import judge, keep_good, op1_quality_divergence


def check(rows, judged):
    got = {r["doc_id"]: r for r in judged}
    for doc_id, text, *_ in rows:
        r = got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.base_quality(text), doc_id
        assert not (r["base_failed"] and r["kept"])


def test_base_counts_equal_brute_force(spark, edge_docs):
    check([tuple(r) for r in edge_docs.collect()], judge(edge_docs).collect())


def test_query_on_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    judged = op1_quality_divergence(spark, SF).collect()
    assert len(judged) == len(docs)
    check([tuple(r) for r in docs], judged)


def test_divergence_drops_odd_characters_and_keeps_prose(spark):
    rows = []
    for i in range(40):
        own = [f"{chr(97 + i % 26)}{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + i // 26)}ness" for k in range(60)]  # no window twice
        link = "the of and to in a is that for it was on are as with".split()
        rows.append((i, " ".join(w for k, x in enumerate(own) for w in (x, link[k % 15])), "en"))
    odd = " ".join(f"a{chr(97 + k % 26)}{chr(97 + k // 26)}$$%%##" for k in range(120))
    rows.append((99, odd, "en"))
    judged = {r["doc_id"]: r for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not any(r["base_failed"] for r in judged.values())
    assert not judged.pop(99)["kept"]
    assert all(r["kept"] for r in judged.values())


def test_short_texts_are_not_judged_by_histograms(spark):
    odd = " ".join(f"{chr(97 + k)}$$%" for k in range(22))
    docs = spark.createDataFrame([(1, odd, "en"), (2, "the of and to in a is that for it was on are as with he be at by this from or", "en")], "doc_id long, text string, lang string")
    assert {r["doc_id"]: r["kept"] for r in judge(docs).collect()} == {1: True, 2: True}


def test_empty_table_and_clashing_columns(spark, empty_docs, clashing_docs):
    assert judge(empty_docs).count() == 0
    assert keep_good(empty_docs).count() == 0
    kept = keep_good(clashing_docs)
    assert kept.columns == clashing_docs.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} <= {r["doc_id"] for r in clashing_docs.select("doc_id").collect()}
    # equal rows are judged alike and all stay
    assert kept.filter("doc_id = 1").count() in (0, 2)
