"""The corpus pipeline against a plain version, stage by stage."""

import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from emberline.llm.shared import materialise

from .test_dedup import expected_near, plain_lines
from .test_models import plain_mix
from .texts import ROWS, frame

DIR = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def check(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    now, columns = materialise(docs, "t"), docs.columns
    for name, stage in pipeline.STAGES:
        before, after = rows_of(now), materialise(stage(spark, now, DIR), "t")
        if name == "language_id":
            want = [r for r in before if any(c.isalpha() for c in r[1] or "")]
            assert sorted((str(r[0]), r[1]) for r in rows_of(after)) == sorted((str(r[0]), r[1]) for r in want)
            assert all(r[2] for r in rows_of(after))
        elif name == "line_dedup":
            want = plain_lines(before)
            assert sorted((str(r[0]), r[1], r[4]) for r in rows_of(after)) == sorted((str(i), t, len(t)) for i, _, _, t in want)
        elif name == "simhash_near_dedup":
            want = {c for _, _, c in expected_near(before)}
            assert sorted(str(r[0]) for r in rows_of(after)) == sorted(map(str, want))
        elif name == "mixing":
            _, _, taken = plain_mix(before)
            sizes = {(r[0], r[3]): len((r[1] or "").encode().split()) for r in before}
            want = sorted(str(k[0]) for k, v in taken.items() if sizes[k] for _ in range(v[0] // sizes[k]))
            assert sorted(str(r[0]) for r in rows_of(after) if (r[1] or "").split()) == want
        else:
            for r, (_, text, *_) in zip(after.orderBy("doc_id", "ids_sha256").collect(), sorted(before, key=lambda r: (r[0] is not None, r[0] or 0))):
                if r.doc_id is not None:
                    ids = library.encode(text, add_special_tokens=False).ids
                    assert (list(r.ids), r.n_tokens) == (ids, len(ids)) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
                    assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
            return after
        assert after.columns == columns
        now = after


def test_pipeline_on_documents(spark):
    after = check(spark, spark.read.parquet(f"{DIR}/documents.parquet"))
    run = pipeline.run(spark, DIR)
    assert run.columns == after.columns and run.count() == after.count()
    total = F.sum(F.xxhash64("doc_id", "ids_sha256").cast("decimal(38,0)"))
    assert run.agg(total).first() == after.agg(total).first()


def test_pipeline_on_hard_rows(spark):
    check(spark, frame(spark, ROWS, ("__note", "h", "row", "a.b", "__id", "__fp", "__key", "__lang", "__lines")))


def test_pipeline_on_an_empty_table(spark):
    assert check(spark, frame(spark, [])).count() == 0


def test_language_stage_without_labels(spark):
    unlabelled = [(i, t, None, s, n) for i, t, _, s, n in ROWS]
    got = rows_of(pipeline.language(spark, frame(spark, unlabelled, ("__lang",)), DIR))
    want = [r for r in unlabelled if any(c.isalpha() for c in r[1] or "")]
    assert sorted((str(r[0]), r[1]) for r in got) == sorted((str(r[0]), r[1]) for r in want) and {r[2] for r in got} == {"und"}
