"""The pipeline's stages against the operators' brute-force versions, each on its own input."""

import test_minhash
import test_native
import test_suffixes
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from tq.llm.common import saved, table
from tq.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def extra_rows(spark):
    """Rows that are hard for one stage or another."""
    rows = [
        (None, "one text without an id, which is kept", None, None, None), (9001, None, "en", "a", 0), (9002, "", "en", "a", 0), (9003, "12 34 ...", None, None, 9),
        (9004, "the same row twice", "en", "a", 18), (9004, "the same row twice", "en", "a", 18), (9005, "the same row twice", "en", "a", 18),
        (9006, "é" * 250 + " and " + "ß" * 300, "de", "b", 555), (9007, "x " + "é" * 250, "fr", "b", 252),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark):
    docs = table(spark, SF, "documents").select(COLUMNS).unionByName(extra_rows(spark))
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    before = {}
    for name, stage in corpus_pipeline.STAGES:
        rows = [tuple(r) for r in docs.collect()]
        out = saved(stage(spark, docs, SF), f"test-{name}")
        got = sorted((tuple(r) for r in out.collect()), key=test_minhash.key) if name != "encoding" else out.collect()
        if name == "language_id":
            want = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
        elif name == "near_duplicates":
            groups = test_minhash.expected([(r[0], r[1]) for r in rows], 80)
            heads = {d for d, _, c in groups if d == c}
            assert len(got) == len({c for _, _, c in groups})
            assert {r[0] for r in got} == heads
            want = got
            assert set(got) <= set(rows)
        elif name == "repeated_passages":
            left = test_suffixes.without_passages([r[1] for r in rows], corpus_pipeline.PASSAGE_WORDS)
            by_id = {r[0]: r for r in got}
            assert len(got) == len(rows)
            for r, text in zip(rows, left, strict=True):
                assert by_id[r[0]] == (r[0], text, *r[2:4], len(text))
            assert left != [r[1] for r in rows]
            want = got
        elif name == "decontamination":
            want = [r for r in rows if not test_native.expected_hits(r[1], items)[1]]
            assert len(want) < len(rows)
        else:
            tokenizer = Tokenizer.from_file(tokenizer_path())
            text = {r[0]: r[1] for r in rows}
            assert len(got) == len(rows) and all(r.round_trip for r in got)
            for r in got:
                assert r.ids == tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
            break
        assert got == sorted(want, key=test_minhash.key), name
        assert out.columns == COLUMNS
        before[name] = docs = out


def test_run_equals_the_stages_and_empty_tables_pass(spark):
    assert __spark_entry__.queries()["pipeline"](spark, SF).count() > 0
    docs = table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), "test-empty")
        assert docs.count() == 0


def test_language_id_drops_what_is_in_no_learned_language(spark):
    docs = table(spark, SF, "documents").select(COLUMNS)
    foreign = [(9101, "это русский текст о погоде в Москве и других городах", None, "a", 52), (9102, "12 34", None, "a", 5)]
    out = corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(foreign, docs.schema)), SF)
    assert not [r.doc_id for r in out.where("doc_id > 9000").collect()]
    assert out.count() == docs.where("text rlike '[a-zA-Z]'").count()
