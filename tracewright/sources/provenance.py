"""Fingerprints, manifests and their verification; exports that can be repeated.

An output is a directory of part files. Executors hash the files (``binaryFile``
and ``sha2`` for small ones, blocks of a mebibyte else); the driver gets one row
per file and hashes the sorted names and digests.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

BLOCK = 1 << 20


def _store(path: str):
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def files_of(path: str) -> list[str]:
    """Data files under a path, sorted; names that start with _ or . are none."""
    store, root = _store(path)
    info = store.get_file_info(root)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [root]
    found = store.get_file_info(fs.FileSelector(root, recursive=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))


def file_sha256(path: str) -> str:
    store, name = _store(path)
    digest = hashlib.sha256()
    with store.open_input_stream(name) as f:
        while block := f.read(BLOCK):
            digest.update(block)
    return digest.hexdigest()


def digests(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """(name, bytes, sha256) of each file; the executors read them by blocks."""
    names = files_of(path)
    if not names:
        return []

    def run(batches):
        for b in batches:
            rows = []
            for name in b.column(0).to_pylist():
                store, at = _store(name)
                rows.append((name, store.get_file_info(at).size, file_sha256(name)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.string()))], ["name", "bytes", "sha256"])

    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(min(len(names), 1000))
    return sorted((r[0], r[1], r[2]) for r in df.mapInArrow(run, "name string, bytes long, sha256 string").collect())


def fingerprint(spark: SparkSession, path: str) -> dict:
    """path, sha256 and size_bytes. One file's is its own hash, a directory's that
    of its files' sorted base names and hashes."""
    got = digests(spark, path)
    if len(got) == 1 and got[0][0] == _store(path)[1]:
        whole = got[0][2]
    else:
        whole = hashlib.sha256("\n".join(f"{n.rpartition('/')[2]} {h}" for n, _, h in got).encode()).hexdigest()
    return {"path": path, "sha256": whole, "size_bytes": sum(b for _, b, _ in got), "files": len(got)}


def write_manifest(spark: SparkSession, path: str, source: str, events: str, alerts: str | None, summary: dict, stages: dict) -> dict:
    """Writes the manifest of a run; ``provenance_verified`` says whether the
    outputs, read again, still have the hashes that are written down."""
    outputs = {"canonical_events": fingerprint(spark, events) | {"format": summary.get("output_format"), "events_count": summary.get("parsed_ok", 0)}}
    if alerts:
        outputs["threat_alerts"] = fingerprint(spark, alerts) | {"alerts_count": summary.get("alerts_generated", 0)}
    data = {
        "manifest_schema_version": "tracewright-provenance-1", "execution_id": str(uuid.uuid4()), "generated_at_utc": datetime.now(timezone.utc).isoformat(),
        "input": fingerprint(spark, source), "outputs": outputs, "pipeline_stages": stages, "performance": {k: summary.get(k, 0.0) for k in ("elapsed_seconds", "events_per_second")},
    }
    data["provenance_verified"] = not any(_differs(spark, x) for x in [data["input"], *outputs.values()])
    store, name = _store(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name) as f:
        f.write(json.dumps(data, indent=2).encode())
    return data


def _differs(spark: SparkSession, entry: dict) -> str | None:
    if not entry.get("path") or not entry.get("sha256"):
        return None
    try:
        now = fingerprint(spark, entry["path"])["sha256"]
    except FileNotFoundError:
        return f"{entry['path']} is missing"
    return None if now == entry["sha256"] else f"{entry['path']} has changed: {entry['sha256'][:16]}… expected, {now[:16]}… found"


def verify_manifest(spark: SparkSession, path: str) -> tuple[bool, list[str]]:
    """Whether input and outputs are as the manifest says, and what is not."""
    try:
        store, name = _store(path)
        with store.open_input_stream(name) as f:
            data = json.loads(f.read())
    except FileNotFoundError:
        return False, [f"no manifest at {path}"]
    except (ValueError, UnicodeDecodeError) as e:
        return False, [f"the manifest is no JSON: {e}"]
    entries = [data.get("input") or {}, *(data.get("outputs") or {}).values()]
    errors = [e for e in (_differs(spark, x) for x in entries) if e]
    return not errors, errors


def chained(spark: SparkSession, manifests: list[str]) -> list[str]:
    """What breaks a chain in which each manifest's input is the one's output before."""
    broken, last = [], None
    for path in manifests:
        store, name = _store(path)
        with store.open_input_stream(name) as f:
            data = json.loads(f.read())
        if last and data["input"]["sha256"] != last:
            broken.append(f"{path}: its input is not the output before it")
        last = data["outputs"]["canonical_events"]["sha256"]
    return broken


def export_once(df: DataFrame, path: str, source_sha256: str, version: str) -> bool:
    """Writes Parquet unless a complete export of the same source and version is
    there (then False). A directory without its mark is refused, not mixed with."""
    spark, (store, root) = df.sparkSession, _store(path)
    mark = f"{root}/_export.json"
    if store.get_file_info(mark).type == fs.FileType.File:
        with store.open_input_stream(mark) as f:
            have = json.loads(f.read())
        same = have["source_sha256"] == source_sha256 and have["version"] == version
        if same and fingerprint(spark, path)["sha256"] == have["sha256"]:
            return False
        raise ValueError(f"{path} holds another export" if not same else f"{path} has changed since its export")
    if store.get_file_info(root).type != fs.FileType.NotFound and files_of(path):
        raise ValueError(f"{path} holds part of an export")
    df.write.mode("append").parquet(path)
    body = {"source_sha256": source_sha256, "version": version, "sha256": fingerprint(spark, path)["sha256"]}
    with store.open_output_stream(mark + ".tmp") as f:
        f.write(json.dumps(body).encode())
    store.move(mark + ".tmp", mark)
    return True
