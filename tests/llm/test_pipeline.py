import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from cdclake.llm import secrets

from . import corpus
from .test_secrets import made


def test_stages_take_effect_and_keep_columns(spark, root):
    rows = [*corpus.documents(), *[(5000 + i, *r[1:]) for i, r in enumerate(made())]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    item = rows[20][1]
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    left = spark.read.parquet(f"{root}/documents.parquet")
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, left, root)
        assert out.columns == docs.columns
        assert out.dtypes == docs.dtypes
        out.write.parquet(f"{root}/{k}")
        left = spark.read.parquet(f"{root}/{k}")
        seen[name] = left.collect()
    texts = {r[0]: r[1] for r in rows}
    ids = [r.doc_id for r in seen["language_id"]]
    # Without letters: three and a row without anything. One word 3,000 times is like no language.
    assert not {400, 401, 404, 406} & set(ids) and len(ids) == len(rows) - 5
    near = [r.doc_id for r in seen["ngram_jaccard_join"]]
    assert not set(range(100, 110)) & set(near) and set(range(10)) <= set(near) and near.count(405) == 1
    assert 403 not in near and 402 in near
    clean = [r.doc_id for r in seen["benchmark_decontamination"]]
    assert set(near) - set(clean) == {20}
    final = {r.doc_id: r for r in seen["secret_scan"]}
    assert len(seen["secret_scan"]) == len(clean)
    for i, r in final.items():
        changed = i is not None and i >= 5000 and (i - 5000) % 4 < 2
        assert (secrets.MASK in r.text) == changed and (changed or i is None or r.text == texts[i])
        assert r.n_chars == len(r.text)
    packed = corpus_pipeline.STAGES[-1][1](spark, left, root).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in seen["secret_scan"])
    assert sum(r.length for r in packed) == total
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, root).select("doc_id").distinct().collect() if r.doc_id is not None) == sorted(
        i for i in final if i is not None)
