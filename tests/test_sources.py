"""Readers, sinks and the whole pipeline on files made here."""

import json
import struct
import zlib

import pytest

from millrace import registry
from millrace.operators import images
from millrace.plans import pipeline
from millrace.sources import landing, readers, sinks


def png(width=4, height=3):
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    body = zlib.compress(b"".join(b"\x00" + b"\x01\x02\x03" * width for _ in range(height)))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", body) + chunk(b"IEND", b"")


@pytest.fixture()
def project(tmp_path):
    raw = tmp_path / "data/raw"
    articles = raw / "fake_real_news"
    articles.mkdir(parents=True)
    (articles / "Fake.csv").write_text('title,text,subject,date\n"t, 1","first ""quoted"" line\nsecond line",news,"Jan 1"\nt2,same text,news,x\nt3,,news,x\n')
    (articles / "True.csv").write_text("title,text,subject,date\nt4,LONDON (Reuters) - true text,news,x\nt5,same text,news,x\nt6,Same TEXT!,news,x\nt7,more truth,news,x\n")
    claims = raw / "claim_verification"
    claims.mkdir()
    lines = [{"id": i, "claim": f"claim {i}", "label": ("SUPPORTS", "REFUTES", "NOT ENOUGH INFO")[i % 3], "evidence": [[[1, None, "E", i]]]} for i in range(30)]
    (claims / "train.jsonl").write_text("\n\n".join(map(json.dumps, lines)) + "\n")
    statements = raw / "fact_checking"
    statements.mkdir()
    rows = [[f"{i}.json", ("true", "false", "half-true")[i % 3], f'an "unbalanced {i}', "s", "p", "j", "st", "pa", "1", "2", "3", "4", "5", "NA"] for i in range(12)]
    (statements / "train.tsv").write_text("\n".join("\t".join(r) for r in rows) + "\nshort\ttrue\tshort row\n")
    texts = raw / "ai_text_detection"
    texts.mkdir()
    (texts / "webtext.train.jsonl").write_text('{"id": 1, "text": "human one"}\n{"id": 2}\n')
    (texts / "small-117M.train.jsonl").write_text('{"id": 1, "text": "machine one"}\n')
    for fold in ("train", "test"):
        for label in ("REAL", "FAKE"):
            folder = raw / "image_forensics" / fold / label
            folder.mkdir(parents=True)
            (folder / f"{fold}{label}.PNG").write_bytes(png())
    (raw / "image_forensics/train/REAL/bad.png").write_bytes(png()[:30])
    (raw / "image_forensics/train/REAL/empty.jpg").write_bytes(b"")
    (raw / "image_forensics/train/REAL/notes.txt").write_text("no image")
    return tmp_path


def test_readers(spark, project):
    raw = project / "data/raw"
    rows = readers.read_articles(spark, raw / "fake_real_news").orderBy("row_seq").collect()
    assert [r["row_seq"] for r in rows] == list(range(7)) and [r["label"] for r in rows] == ["Fake"] * 3 + ["True"] * 4
    assert rows[0]["text"] == 'first "quoted" line\nsecond line' and rows[0]["title"] == "t, 1"
    claims = readers.read_claims(spark, raw / "claim_verification").orderBy("row_seq").collect()
    assert [r["claim"] for r in claims] == [f"claim {i}" for i in range(30)] and json.loads(claims[3]["evidence"]) == [[[1, None, "E", 3]]]
    statements = readers.read_statements(spark, raw / "fact_checking").orderBy("row_seq").collect()
    assert len(statements) == 13 and statements[5]["statement"] == 'an "unbalanced 5' and statements[12]["context"] is None and statements[0]["context"] is None
    plain = readers.read_statements(spark, raw / "fact_checking", quote=None, na_tokens=False).orderBy("row_seq").collect()
    assert [r["statement"] for r in plain] == [r["statement"] for r in statements] and plain[0]["context"] == "NA"
    texts = readers.read_generated_text(spark, raw / "ai_text_detection").orderBy("row_seq").collect()
    assert [(r["text"], r["source"]) for r in texts] == [("human one", "human"), ("", "human"), ("machine one", "machine")]
    listed = readers.list_images(spark, raw / "image_forensics").orderBy("row_seq").collect()
    assert [r["label"] for r in listed] == ["REAL"] * 4 + ["FAKE"] * 2
    with pytest.raises(FileNotFoundError):
        readers.read_articles(spark, raw / "absent")


def test_bad_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"text": "a"}\nnot json\n{"text": "b"}\n')
    schema = readers._strings(["text"])
    with pytest.raises(Exception):
        readers.read_jsonl(spark, tmp_path / "x.jsonl", schema).collect()
    rows = readers.read_jsonl(spark, tmp_path / "x.jsonl", schema, "skip").cache()
    assert [r["text"] for r in readers.good_lines(rows).collect()] == ["a", "b"] and readers.bad_lines(rows).count() == 1


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc'), (2, None)], "id int, t string")
    for name in ("t.parquet", "t.csv"):
        sinks.write_table(df, tmp_path / name)
        assert readers.read_table(spark, tmp_path / name).count() == 2
    sinks.write_jsonl(df, tmp_path / "t.jsonl")
    assert sorted(r["id"] for r in readers.read_table(spark, tmp_path / "t.jsonl").collect()) == [1, 2]
    assert sinks.markdown_table(df).splitlines()[0] == "| id | t |"


def test_quoted_statements(spark, tmp_path):
    row = lambda i, statement: "\t".join([f"{i}.json", "true", statement, *"sabcdefghij"])
    (tmp_path / "train.tsv").write_text("\n".join([row(0, '"two\nlines and ""quotes"""'), row(1, "None"), row(2, "Nancy")]) + "\n")
    got = readers.read_statements(spark, tmp_path).orderBy("row_seq").collect()
    assert [r["statement"] for r in got] == ['two\nlines and "quotes"', None, "Nancy"]


def test_publish(spark, tmp_path):
    table = lambda name, n: sinks.write_table(spark.range(n), tmp_path / name)
    count = lambda: spark.read.parquet(str(tmp_path / "t.parquet")).count()
    for n in (3, 5):
        table("staged.parquet", n)
        sinks.publish(spark, tmp_path / "staged.parquet", tmp_path / "t.parquet")
        assert count() == n and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["t.parquet"]
    (tmp_path / "t.parquet").rename(tmp_path / "_aside_t.parquet")
    sinks.restore(spark, tmp_path / "t.parquet")
    assert count() == 5


def test_landing(tmp_path):
    assert landing.fetch("x", tmp_path / "a.bin", lambda url: [b"12", b"3"]) and not landing.fetch("x", tmp_path / "a.bin")

    def broken(url):
        yield b"1"
        raise OSError("cut")

    def gated():
        raise landing.ManualDownloadRequired("by hand")

    out = landing.fetch_all({"ok": lambda: None, "cut": lambda: landing.fetch("x", tmp_path / "b.bin", broken), "gated": gated})
    assert out["ok"] == "OK" and out["cut"].startswith("FAILED") and out["gated"] == "MANUAL: by hand"
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.bin"]
    assert registry.dataset_status(tmp_path, ["a.bin", "b.bin"]) == {"a.bin": True, "b.bin": False}
    with pytest.raises(landing.ManualDownloadRequired):
        landing.gated(["no-such-command"])


def test_images(spark, project):
    folder = project / "data/raw/image_forensics"
    listed = readers.list_images(spark, folder)
    more = listed.select("image_path").union(spark.createDataFrame([(str(folder / "gone.png"),), ("",)], "image_path string"))
    seen = images.inspect(spark, more, str(folder)).cache()
    assert images.integrity(seen).collect()[0].asDict() == {"valid": 4, "corrupt": 2, "missing": 1}
    assert images.profile(seen).collect()[0]["width_mean"] == 4.0
    assert [tuple(r) for r in images.formats(seen).collect()] == [("PNG", 4)]


def test_pipeline_end_to_end(spark, project):
    config = registry.load_config()
    manager = registry.DatasetManager.from_config(config, project)
    out = pipeline.run_all(spark, manager, config)
    assert all(v == "OK" for stage in out.values() for v in stage.values()), out
    articles = spark.read.parquet(str(manager.processed_path("fake_real_news"))).orderBy("id").collect()
    assert [(r["text"][:10], r["label"]) for r in articles] == [("first \"quo", 0), ("same text", 0), ("true text", 1), ("more truth", 1)]
    manifest = json.loads(manager.lineage_path("fake_real_news").read_text())
    assert [c["n_rows"] for c in manifest["row_count_checkpoints"]] == [7, 7, 6, 5, 4, 4]
    split = spark.read.parquet(str(manager.splits_dir("claim_verification") / "all.parquet"))
    assert split.count() == 30 and {r[0] for r in split.select("split").distinct().collect()} == {"train", "val", "test"}
    assert all(s == {"downloaded": True, "cleaned": True, "split": True} for s in manager.status_report().values())
    assert "## fact_checking" in manager.eda_path().read_text()
    (project / "data/raw/fake_real_news/True.csv").unlink()
    assert pipeline.clean_all(spark, manager, config)["fake_real_news"].startswith("SKIPPED")


def test_command_and_log(spark, project):
    from millrace.__main__ import main

    assert main(["--root", str(project), "--log-dir", str(project / "logs"), "clean", "split"]) == 0
    (file,) = (project / "logs").iterdir()
    assert "clean fact_checking: OK" in file.read_text() and "split claim_verification: OK" in file.read_text()
    with pytest.raises(SystemExit):
        main(["no-such-stage"])
