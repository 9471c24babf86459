import json

from termloom import command
from termloom.functions.register import register_udfs


def args(*argv):
    return command.parser().parse_args(list(argv))


def test_run_and_verify(spark, tmp_path, capsys):
    at = tmp_path / "corpus"
    at.mkdir()
    body = {"sentences": [{"sent_id": i * 10, "src": f"源头句子{i}", "tgt": f"frase numero {i}"} for i in (1, 2, 3)]}
    for name in ("zh-es_a_b_1_align.qc.json", "zh-es_a_b_2_align.qc.json"):
        (at / name).write_text(json.dumps(body))
    (at / "zh-es_a_c_3_align.qc.json").write_text(json.dumps({"sentences": [{"sent_id": 1, "src": "不同的句子", "tgt": "otra frase"}]}))
    base = ["run", "--corpus", str(at), "--out", f"{tmp_path}/out"]
    assert command.run(spark, args(*base)) == 2
    assert command.run(spark, args(*base, "--allow", "degraded", "--dry-run")) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["batches"] == 2
    assert command.run(spark, args(*base, "--allow", "degraded")) == 0
    rows = spark.read.parquet(f"{tmp_path}/out/tables").collect()
    assert sorted((r.out_name, r.sent_id) for r in rows) == sorted([(f"zh-es_a_b_{f}_term.xlsx", i) for f in (1, 2) for i in (10, 20, 30)] + [("zh-es_a_c_3_term.xlsx", 1)])
    assert (tmp_path / "out/terms.zip").exists()
    assert command.run(spark, args(*base, "--allow", "degraded")) == 2
    assert command.check(spark, args("verify", f"{tmp_path}/out", "--expect-files", "3")) == 0
    assert command.check(spark, args("verify", f"{tmp_path}/out", "--expect-files", "4")) == 1
    assert command.run(spark, args(*base, "--allow", "degraded", "--registered-sentences", "99")) == 2


def test_sql_functions(spark):
    assert "anchor_slice" in register_udfs(spark)
    r = spark.sql("SELECT is_meaningful('1a') AS m, cjk_ratio('汉 a') AS c, foreign_side('汉', 'a') AS f, anchor_slice('CASA', 'La Casa') AS s").first()
    assert (r.m, r.c, r.f, r.s) == (True, 0.5, "tgt", "Casa")
