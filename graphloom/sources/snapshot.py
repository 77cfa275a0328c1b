"""Snapshots of exports: configuration, safe trees, pruning, archives with digests, the lock and its check.

Files of a group are rows (name, content) of a table, so digests, pruning and redaction
are column work; an archive is one file of one group and is packed by one task.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import tarfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path, PurePosixPath

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

#: What makes archives of equal files equal bytes.
MTIME, MODE, LOCK_VERSION, LEVEL, NOTE_LIMIT = 0, 0o644, 1, 10, 500
DATE = re.compile(r"\A(\d{4}-\d{2}-\d{2})(?:\.\.(\d{4}-\d{2}-\d{2}))?\Z")


class Refused(ValueError):
    """A configuration, file or group that must not become a snapshot."""


# -- groups and configuration ------------------------------------------------------------


@dataclass(frozen=True)
class Spec:
    """A group's export: its file, shape, the fields that its reader knows, and what marks it as that export."""

    file: str
    shape: str
    identity: tuple[str, ...]
    known: tuple[str, ...]


#: The groups, each by file, shape, spellings of its identity, and the fields that its reader takes.
GROUPS = {
    "cmssw": Spec("records.json", "list", ("label",), ("label", "type", "state", "architecture", "release_notes", "release_date", "production_architecture")),
    "conddb": Spec("records.json", "list", ("name", "global_tag"), ("name", "global_tag", "release", "scenario", "description", "created_at")),
    "dbs": Spec("records.json", "list", ("dataset", "name"), ("dataset", "name", "data_tier", "primary_dataset", "processed_dataset", "physics_group", "creation_date", "dataset_access_type", "total_size_bytes", "total_files", "total_events")),
    "cric_sites": Spec("sites.json", "mapping", (), ("tier_level", "status", "sitedb_title", "computeunits", "country")),
    "cric_services": Spec("services.json", "mapping", (), ("endpoint", "rcsite", "type", "state")),
    "dqm": Spec("records.json", "list", ("cert_name", "filename"), ("cert_name", "filename", "run_range", "num_lumi_sections", "datasets")),
    "gocdb": Spec("downtimes.json", "list", ("downtime_id", "id"), ("downtime_id", "id", "primary_key", "classification", "severity", "description", "start_date", "end_date", "hosted_by", "service_type", "hostname")),
    "wmstats": Spec("records.json", "list", ("workflow_name", "RequestName"), ("workflow_name", "RequestName", "status", "campaign", "priority", "cmssw_version", "input_dataset", "output_datasets", "created_at", "updated_at")),
    "jira": Spec("records.json", "list", ("key", "issue_key"), ("key", "issue_key", "summary", "description", "project", "status", "priority", "assignee", "reporter", "components", "labels", "typed_links", "recent_comments")),
    "docs": Spec("records.json", "list", ("url",), ("title", "url", "body", "site_name", "source_repo", "path")),
    "cds": Spec("records.json", "list", ("oai_id",), ("oai_id", "datestamp", "title", "description", "creators", "identifiers", "deleted")),
    "indico": Spec("events.json", "mapping", (), ("title", "url", "description", "startDate", "endDate", "type", "category", "categoryId", "speakers", "chairs", "folders", "_pdf_texts", "_contributions_text")),
    "cmssst": Spec("records.json", "list", ("site",), ("site", "time", "alert", "msg", "ggus", "today")),
    "hypernews": Spec("records.json", "list", ("thread_id",), ("thread_id", "title", "url", "forum_name", "body", "author", "date", "reply_count")),
}


@dataclass(frozen=True)
class Group:
    name: str
    path: str
    collected: str
    drop: tuple[str, ...] = ()
    keep: tuple[str, ...] = ()
    note: str | None = None
    file_dates: tuple[tuple[str, str], ...] = field(default=())


def collected_date(value: object) -> str:
    """A collection date or range as text; anything else is refused."""
    from datetime import date

    found = DATE.match(str(value))
    try:
        ends = [date.fromisoformat(d) for d in found.groups() if d] if found else []
    except ValueError:
        ends = []
    if not ends or ends != sorted(ends):
        raise Refused(f"{value!r} is no collection date or range")
    return str(value)


def _only(raw: object, allowed: set[str], what: str) -> dict:
    if not isinstance(raw, dict) or not raw:
        raise Refused(f"{what} is a mapping")
    if unknown := sorted(set(raw) - allowed):
        raise Refused(f"{what}: unknown keys {unknown}")
    return raw


def parse_config(raw: object, base: str = ".") -> tuple[str, int, list[Group]]:
    """A snapshot's name, compression level and groups in name order; every fault is refused."""
    top = _only(raw, {"snapshot", "zstd_level", "groups"}, "the configuration")
    name, level = top.get("snapshot"), top.get("zstd_level", LEVEL)
    if not isinstance(name, str) or not re.fullmatch(r"[A-Za-z0-9._-]+", name):
        raise Refused("a snapshot's name is letters, digits, dots, underscores and dashes")
    if type(level) is not int or not 1 <= level <= 19:
        raise Refused("the compression level is a whole number from 1 to 19")
    groups = []
    for key, row in sorted(_only(top.get("groups"), set(GROUPS), "groups").items()):
        row = _only(row, {"path", "collected", "drop_fields", "keep_fields", "file_dates", "note"}, f"group {key}")
        if not row.get("path") or row.get("collected") in (None, ""):
            raise Refused(f"group {key}: path and collected are required")
        lists = [row.get(k) or [] for k in ("drop_fields", "keep_fields")]
        if not all(isinstance(x, list) and all(isinstance(v, str) and v for v in x) for x in lists):
            raise Refused(f"group {key}: fields are lists of names")
        note = row.get("note")
        if note is not None and (not isinstance(note, str) or not note.strip() or len(note) > NOTE_LIMIT):
            raise Refused(f"group {key}: a note is text of at most {NOTE_LIMIT} letters")
        dates = row.get("file_dates")
        if dates is not None and (not isinstance(dates, dict) or not dates):
            raise Refused(f"group {key}: file_dates maps files to dates")
        path = os.path.expanduser(str(row["path"]))
        groups.append(Group(
            key, path if os.path.isabs(path) else os.path.join(base, path), collected_date(row["collected"]), tuple(sorted(set(lists[0]))), tuple(sorted(set(lists[1]))), note,
            tuple(sorted((str(f), collected_date(d)) for f, d in (dates or {}).items())),
        ))
    return name, level, groups


def safe_tree(root: str) -> list[str]:
    """The files below a folder, sorted; a link, a hidden name or anything outside refuses the tree."""
    top, found = Path(root).resolve(strict=True), []
    for folder, folders, files in os.walk(top):
        for name in [*folders, *files]:
            path = Path(folder) / name
            if name.startswith(".") or path.is_symlink() or not path.resolve().is_relative_to(top):
                raise Refused(f"{path.relative_to(top).as_posix()}: hidden, a link, or outside the folder")
        found += [(Path(folder) / name).relative_to(top).as_posix() for name in files]
    return sorted(found)


def safe_name(name: Column) -> Column:
    """Whether a member's name stays inside its archive."""
    return (name != "") & ~name.startswith("/") & ~name.rlike(r"(?:^|/)\.\.(?:/|$)|\\|\x{0}")


# -- records -----------------------------------------------------------------------------


def pruned(records: DataFrame, spec: Spec, keep: tuple[str, ...] = (), drop: tuple[str, ...] = (), raw: str = "raw") -> DataFrame:
    """Records (JSON text) with the fields that the group knows, and ``keep``, but without ``drop``; values as they are."""
    names = sorted((set(spec.known) | set(keep)) - set(drop))

    @F.udf(returnType=StringType(), useArrow=True)
    def chosen(text):
        found = json.loads(text)
        return json.dumps({k: v for k, v in found.items() if k in names}, ensure_ascii=False, separators=(",", ":")) if isinstance(found, dict) else text

    return records.withColumn(raw, chosen(raw))


def shape_verdict(records: DataFrame, spec: Spec, raw: str = "raw") -> DataFrame:
    """One row on a group's records: how many, how many carry an identity, and whether the group is accepted.

    Every record must be an object with one of the identity's spellings (of a mapping, an
    object); nineteen in twenty must carry a field that the group's reader knows.
    """
    fields = F.from_json(raw, "map<string,string>")
    named = F.lit(not spec.identity)
    for name in spec.identity:
        named = named | (F.coalesce(F.try_element_at(fields, F.lit(name)), F.lit("")) != "")
    known = F.size(F.array_intersect(F.map_keys(fields), F.array(*map(F.lit, spec.known)))) > 0
    counted = records.agg(F.count(F.lit(1)).alias("records"), F.count_if(fields.isNotNull() & named).alias("identified"), F.count_if(F.coalesce(known, F.lit(False))).alias("signed"))
    return counted.withColumn("accepted", (F.col("records") > 0) & (F.col("identified") == F.col("records")) & (F.col("signed") >= F.col("records") * 0.95))


# -- archives ----------------------------------------------------------------------------


def contents_digest(files: DataFrame, *by: str) -> DataFrame:
    """The digest of each group's files (name, content): over names and content digests, in name order.

    Only names and digests are gathered; contents stay in their rows.
    """
    each = files.select(*by, F.struct("name", F.sha2("content", 256).alias("digest")).alias("f"), F.octet_length("content").alias("_size"))
    lines = F.transform(F.array_sort(F.collect_list("f")), lambda f: F.concat(f["name"], F.lit("\0"), f["digest"], F.lit("\n")))
    return each.groupBy(*by).agg(F.sha2(F.array_join(lines, ""), 256).alias("contents_sha256"), F.count(F.lit(1)).alias("file_count"), F.sum("_size").alias("content_bytes"))


def pack(files: dict[str, bytes], level: int = LEVEL) -> bytes:
    """Equal files give equal bytes: a sorted tar without times or owners, in one zstandard frame."""
    import zstandard

    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=tarfile.PAX_FORMAT) as tar:
        for name in sorted(files):
            member = tarfile.TarInfo(name)
            member.size, member.mtime, member.mode = len(files[name]), MTIME, MODE
            tar.addfile(member, io.BytesIO(files[name]))
    return zstandard.ZstdCompressor(level=level, threads=0).compress(out.getvalue())


def unpack(data: bytes) -> dict[str, bytes]:
    """The members of an archive; unsafe or repeated ones refuse it."""
    import zstandard

    members: dict[str, bytes] = {}
    try:
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        with tarfile.open(fileobj=io.BytesIO(plain), mode="r:") as tar:
            for member in tar:
                path = PurePosixPath(member.name)
                if not member.isreg() or path.is_absolute() or ".." in path.parts:
                    raise Refused(f"unsafe member {member.name!r}")
                if member.name in members:
                    raise Refused(f"duplicate member {member.name!r}")
                members[member.name] = tar.extractfile(member).read()
    except (zstandard.ZstdError, tarfile.TarError) as error:
        raise Refused(f"not a readable archive: {error}") from error
    return members


def archives(files: DataFrame, level: int = LEVEL) -> DataFrame:
    """grp, archive bytes, their size and digest, of the files (grp, name, content) of each group, a group a task."""

    def run(group: pa.Table) -> pa.Table:
        data = pack(dict(zip(group.column("name").to_pylist(), group.column("content").to_pylist())), level)
        return pa.table({"grp": [group.column("grp")[0].as_py()], "archive": pa.array([data], pa.binary()), "bytes": pa.array([len(data)], pa.int64()), "sha256": [hashlib.sha256(data).hexdigest()]})

    return files.select("grp", "name", "content").groupBy("grp").applyInArrow(run, "grp string, archive binary, bytes long, sha256 string")


def read_archives(packed: DataFrame) -> DataFrame:
    """grp, name and content of every member of archives (grp, archive); ``problem`` says why one cannot be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    rows = [(grp, n, c, None) for n, c in unpack(data).items()]
                except Refused as error:
                    rows = [(grp, None, None, str(error))]
                columns = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.binary()), pa.array(columns[3], pa.string())], ["grp", "name", "content", "problem"])

    return packed.select("grp", "archive").mapInArrow(run, "grp string, name string, content binary, problem string")


def lock(packed: DataFrame, files: DataFrame) -> DataFrame:
    """The lock's row of each group: archive size and digest, number of files, digest of contents."""
    return packed.select("grp", "bytes", "sha256").join(contents_digest(files, "grp").select("grp", "file_count", "contents_sha256"), "grp")


def verified(locked: DataFrame, packed: DataFrame) -> DataFrame:
    """grp and the first problem of every group that a lock names: null where its archive is as locked."""
    read = read_archives(packed)
    inside = contents_digest(read.where("problem is null"), "grp").select("grp", F.col("file_count").alias("_files"), F.col("contents_sha256").alias("_contents"))
    bad = read.where("problem is not null").select("grp", "problem").distinct()
    found = packed.select("grp", F.octet_length("archive").cast("long").alias("_bytes"), F.sha2("archive", 256).alias("_sha"))
    rows = locked.join(found, "grp", "left").join(inside, "grp", "left").join(bad, "grp", "left")
    problem = (
        F.when(F.col("_bytes").isNull(), "missing")
        .when(F.col("_bytes") != F.col("bytes"), "size differs")
        .when(F.col("_sha") != F.col("sha256"), "digest differs")
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(F.coalesce("_files", F.lit(0)) != F.col("file_count"), "number of files differs")
        .when(F.col("_contents") != F.col("contents_sha256"), "contents differ")
    )
    return rows.select("grp", problem.alias("problem"))


# -- sinks -------------------------------------------------------------------------------


def write_records(records: DataFrame, path: str) -> int:
    """Records as JSON lines, put in place at once: written beside, then renamed; an empty table is refused.

    Returns how many were written; a reader never sees half of them, whatever fails.
    """
    spark, beside = records.sparkSession, f"{path.rstrip('/')}.writing"
    records.write.mode("overwrite").json(beside)
    count = spark.read.schema(records.schema).json(beside).count()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not count:
        fs.delete(hadoop.Path(beside), True)
        raise Refused(f"{path}: no records to write")
    fs.delete(hadoop.Path(path), True)
    if not fs.rename(hadoop.Path(beside), hadoop.Path(path)):
        raise OSError(f"{path} cannot be put in place")
    return count


def page_index(nodes: DataFrame) -> DataFrame:
    """The distinct node ids in order, one a line: what ``write.text`` saves as a page index."""
    return nodes.select(F.col("node_id").alias("value")).distinct().orderBy("value")

