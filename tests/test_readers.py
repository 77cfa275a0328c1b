"""Readers over files, and the parts of snapshots that touch folders."""

from __future__ import annotations

import json
import os

import pytest

from graphloom.functions import redaction as D
from graphloom.sources import readers as S, snapshot as N


@pytest.mark.parametrize(
    "content,status,scope,count",
    [
        (json.dumps([{"dataset": "/a/b/RAW"}, {"dataset_name": "/a/c/AOD"}]), "ok", True, 2), (json.dumps([{"dataset": "/a/b/RAW"}, {"x": 1}, 5]), "endpoint_failed", False, 1),
        ("[]", "cache_missing", False, 0), ("{}", "endpoint_failed", False, 0), ("[{", "cache_missing", False, 0), ("", "cache_missing", False, 0), (None, "cache_missing", False, 0), ("3", "endpoint_failed", False, 0), (json.dumps([{"x": 1}]), "cache_missing", False, 0),
    ],
)
def test_an_export_is_read_or_refused(spark, tmp_path, content, status, scope, count):
    path = tmp_path / "records.json"
    if content is not None:
        path.write_text(content)
    run = S.Datasets(records_path=str(path)).run(spark)
    health = run.health.first()
    assert (health.status, health.completed_scope, health.record_count) == (status, scope, count)
    assert run.nodes.count() == count
    assert S.Datasets(records_path=str(path)).preflight(spark).first().status == status


def test_no_mode_but_a_completing_one_claims_its_scope(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"dataset": "/a/b/RAW"}]))
    claims = {mode: S.Datasets(records_path=str(tmp_path / "r.json")).run(spark, mode).health.first().completed_scope for mode in ("scope_complete", "reconcile", "sample", "release_new")}
    assert claims == {"scope_complete": True, "reconcile": True, "sample": False, "release_new": False}


def test_a_probe_follows_the_bytes(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('[{"dataset":"/a"}]')
    first = S.Datasets(records_path=str(path)).change_probe(spark).first()[0]
    path.write_text('[{"dataset":"/b"}]')
    assert S.Datasets(records_path=str(path)).change_probe(spark).first()[0] != first


def test_trees_with_links_or_hidden_names_are_refused(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "x.json").write_text("1")
    (tmp_path / "a" / "y.json").write_text("1")
    assert N.safe_tree(str(tmp_path / "a")) == ["b/x.json", "y.json"]
    os.symlink(tmp_path / "a" / "y.json", tmp_path / "a" / "link")
    with pytest.raises(N.Refused):
        N.safe_tree(str(tmp_path / "a"))
    (tmp_path / "a" / "link").unlink()
    (tmp_path / "a" / ".hidden").write_text("")
    with pytest.raises(N.Refused):
        N.safe_tree(str(tmp_path / "a"))


def test_records_are_written_whole_or_not_at_all(spark, tmp_path):
    target = str(tmp_path / "out")
    assert N.write_records(spark.range(3), target) == 3 and N.write_records(spark.range(2), target) == 2
    assert spark.read.json(target).count() == 2
    with pytest.raises(N.Refused):
        N.write_records(spark.range(0), target)
    assert spark.read.json(target).count() == 2


def test_archives_of_equal_files_are_equal_bytes():
    files = {"b": b"2", "a": b"1"}
    assert N.pack(files) == N.pack(dict(reversed(files.items()))) and N.unpack(N.pack(files)) == files
    with pytest.raises(N.Refused):
        N.unpack(b"no archive")


def test_redaction_takes_time_in_proportion():
    import time

    run = "a" * 20_000 + " " + "&amp;" * 4_000 + " " + "b&" * 10_000
    began = time.process_time()
    assert D.without_addresses(run) == run and D.without_addresses(run + " jdoe@cern.ch") == run + " "
    for text in ("a%40" * 5_000, "a@" * 10_000, "x@1.2+" * 4_000, "a@b-" * 5_000, "&#64" * 5_000):
        assert D.without_addresses(text) == text
    for text in ("git@" * 10_000, "git@a.b" * 5_000, " git@x.org:y jdoe@cern.ch" * 2_000):
        D.without_addresses(text)
    assert time.process_time() - began < 10
