import json

from conftest import line
from loglark.__main__ import main


def rows(folder):
    files = sorted(folder.glob("part-*"))
    return [tuple(t.split("\t")) for f in files for t in f.read_text().splitlines()]


def test_jobs_from_file_to_reports(spark, tmp_path):
    """Split, run as two engines with different batch sizes and read the reports."""
    log = tmp_path / "web.log.txt"
    log.write_text(
        "".join(
            line(host=f"h{i % 9}", resource=f"/r{i % 7}", status=[200, 404][i % 2], size=i) + "\n"
            for i in range(90)
        )
        + "junk\n"
    )
    data, root, out = tmp_path / "data", str(tmp_path / "root"), tmp_path / "out"
    for run_id, engine, size in ((1, "mr", 40), (2, "Pig", 40), (3, "mr", 91)):
        main(["split", str(log), str(data), str(size)])
        main(["run", str(data / f"web.log_{size}"), root, str(run_id), "--engine", engine])
    assert sorted(p.name for p in (data / "web.log_40").glob("batch=*")) == [
        "batch=b1_40", "batch=b2_40", "batch=b3_11"
    ]

    main(["report", root, "1", str(out)])
    assert rows(out / "data_quality") == [
        ("mr", "1", "90", "1", "true", "true"),
        ("pig", "2", "90", "1", "false", "true"),
        ("hive", "", "", "", "false", "false"),
        ("mongodb", "", "", "", "false", "false"),
    ]
    assert [r[2] for r in rows(out / "integrity_scorecard")] == [
        "BASELINE", "MATCH", "NO_HISTORY", "NO_HISTORY"
    ]
    assert sorted(r[0] for r in rows(out / "engine_comparison")) == ["mr", "pig"]
    assert [r[0] for r in rows(out / "query_totals")] == ["1", "2", "3"]
    # Runs of 91 records are too small to compare with, so only the target's size is shown.
    assert [r[0] for r in rows(out / "batch_size_runtime")] == ["40"]

    main(["differ", root, "1", str(tmp_path / "differ")])
    assert rows(tmp_path / "differ") == []
    main(["compact", root, "1", "--vacuum"])
    main(["history", root, str(tmp_path / "history")])
    found = [json.loads(r[0]) for r in rows(tmp_path / "history")]
    assert [(r["id"], r["pipeline"], r["dataset"]) for r in found] == [
        (3, "mr", "web.log_91"), (2, "pig", "web.log_40"), (1, "mr", "web.log_40")
    ]


def test_reports_of_the_default_engine(spark, tmp_path):
    """The target's engine has its row whether it is listed or not, and batches have times."""
    log = tmp_path / "web.txt"
    log.write_text("".join(line(host=f"h{i % 5}", status=[200, 500][i % 2]) + "\n" for i in range(60)))
    data, root, out = tmp_path / "data", str(tmp_path / "root"), tmp_path / "out"
    main(["split", str(log), str(data), "30"])
    main(["run", str(data / "web_30"), root, "1", "--separately", "1,2"])
    main(["run", str(data / "web_30"), root, "2", "--engine", "pig"])
    main(["report", root, "1", str(out)])
    assert [(r[0], r[2]) for r in rows(out / "integrity_scorecard")] == [
        ("mr", "NO_HISTORY"), ("pig", "MATCH"), ("hive", "NO_HISTORY"), ("mongodb", "NO_HISTORY"), ("spark", "BASELINE")
    ]
    assert ("spark", "1", "60", "0", "true", "true") in rows(out / "data_quality")
    assert [float(r[2]) > 0 for r in rows(out / "batch_view")] == [True, True]
    assert [(r[0], r[1]) for r in rows(out / "batch_query_times")] == [(b, q) for b in "12" for q in "123"]
    assert {r[0] for r in rows(out / "batch_comparison")} == {"SPARK (Target Exec: 1)"}
    assert all(float(r[1]) > 0 for r in rows(out / "batch_size_avg_time"))
    main(["report", root, "1", str(tmp_path / "few"), "--engines", "pig"])
    assert [r[0] for r in rows(tmp_path / "few" / "data_quality")] == ["pig", "spark"]
