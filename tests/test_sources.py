"""CSV scans and sinks on a hand-written file."""

from pyspark.sql import functions as F

from quillpair.operators import textprep as TP
from quillpair.sources import csv as C

CSV = (
    'context,question,answer\n'
    '"multi\nline","q ""quoted""",a1\n'
    'onlyctx\n'
    'c3,q3,a3,extra\n'
    'NA,q4,a4\n'
    ',q5,a5\n'
)


def _file(tmp_path):
    p = tmp_path / "train.csv"
    p.write_text(CSV)
    return str(p)


def test_projected_read_truncates_long_lines_and_pads_short(spark, tmp_path):
    rows = [tuple(r) for r in C.read_projected(spark, _file(tmp_path)).collect()]
    assert rows == [("multi\nline", 'q "quoted"'), ("onlyctx", None), ("c3", "q3"),
                    ("NA", "q4"), (None, "q5")]


def test_read_all_drops_long_lines_keeps_short(spark, tmp_path):
    df = C.read_all(spark, _file(tmp_path))
    assert df.columns == ["context", "question", "answer"]
    rows = [tuple(r) for r in df.collect()]
    assert rows == [("multi\nline", 'q "quoted"', "a1"), ("onlyctx", None, None),
                    ("NA", "q4", "a4"), (None, "q5", "a5")]


def test_na_tokens_then_dropna_keep_row_index_gaps(spark, tmp_path):
    df = C.read_split(spark, _file(tmp_path), "train")
    df = TP.null_na_tokens(df)
    kept = TP.drop_null_pairs(df)
    assert [r.row_id for r in kept.orderBy("row_id").collect()] == [0, 2]
    assert kept.select("split").distinct().collect()[0][0] == "train"


def test_row_index_is_file_order_over_files_of_any_size(spark, tmp_path):
    rows = []
    for name, n, width in (("a", 3, 1), ("b", 30, 500), ("c", 1, 1), ("d", 200, 50)):
        lines = [f"{name}{i}{'x' * width},q{i}" for i in range(n)]
        (tmp_path / f"{name}.csv").write_text("context,question\n" + "\n".join(lines) + "\n")
        rows += [x.split(",")[0] for x in lines]
    got = {r.row_id: r.context for r in C.read_indexed(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(rows))


def test_sinks_round_trip(spark, tmp_path):
    df = C.read_split(spark, _file(tmp_path), "train")
    out = str(tmp_path / "splits")
    C.write_splits(df, out)
    back = spark.read.parquet(out)
    assert back.count() == 5 and set(back.columns) == {"row_id", "context", "question", "split"}
    C.write_splits(df, str(tmp_path / "splits_csv"), fmt="csv")
    back_csv = C.read_projected(spark, str(tmp_path / "splits_csv" / "split=train"),
                                ("row_id", "context", "question"))
    assert sorted(r.context or "" for r in back_csv.collect()) == sorted(
        r.context or "" for r in df.collect())
    preds = df.select("row_id", F.lit("lead").alias("variant"),
                      F.coalesce("question", F.lit("")).alias("generated"))
    C.write_predictions(preds, str(tmp_path / "preds"))
    assert spark.read.parquet(str(tmp_path / "preds")).filter("variant = 'lead'").count() == 5
    feats = df.select("split", F.array(F.lit(1), F.lit(2)).alias("input_ids"))
    C.write_features(feats, str(tmp_path / "feats"))
    assert spark.read.parquet(str(tmp_path / "feats")).first().input_ids == [1, 2]
