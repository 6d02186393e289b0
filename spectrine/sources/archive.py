"""Integrity-checked archives: a stored ZIP with one manifest and a closed inventory of members.

Order of checks: container, manifest, grammar and rules of every manifest part,
members, hashes, reference closure; only a well-formed archive is then asked whether
its parts can be executed. A table of archives is read through Spark's binary
source; every archive is judged in one task, within the byte budgets below.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import struct
import tempfile
import unicodedata
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import (
    ArchiveError, ArchiveExists, ArchiveFormatError, ArchiveIntegrityError, ArchiveUnsupported, PublishedWithCleanupError,
)

MANIFEST = "manifest.json"
#: Budgets: entries, bytes of a member, of all members, of the manifest, and nesting. Fixed values.
MAX_ENTRIES, MAX_MEMBER, MAX_TOTAL, MAX_MANIFEST, MAX_DEPTH = 256, 134_217_728, 536_870_912, 1_048_576, 64

PROFILE = {1: "spectrine.archive.v1", 2: "spectrine.archive.v2"}
PHYSICAL = {"container": "zip", "compression": "stored", "encryption": "none"}
DISPATCH = {"manifest_first": True, "unknown_versions": "refuse"}
KEYS = {
    "schema_version", "profile", "archive_id", "persistence_kind", "writer", "reader_dispatch", "physical_profile", "replay",
    "payloads", "member_inventory", "migration_provenance", "security", "workspace",
}
ROW_KEYS = {"path", "regular_file", "raw_sha256", "uncompressed_size_bytes", "semantic_fingerprint", "semantic_profile"}
REF_KEYS = {"schema_id", "schema_version", "member_path", "raw_sha256", "semantic_fingerprint", "semantic_profile"}
#: Kinds of replay references and payloads; of payloads, whether any version of this engine executes them.
REPLAY = ("package", "graph", "execution_bundle", "training_outcome", "prediction_cache", "score_set")
PAYLOADS = {"model": 2, "model_options": None, "dataset": None, "conformal": None, "robustness": None, "host_artifacts": None}
UNSAFE_HOSTS = ("pickle", "joblib", "rds")

ID = r"^[A-Za-z0-9_.:-]{1,128}$"
SHA = r"^[0-9a-f]{64}$"
NAMESPACE = {1: r"^[a-z][a-z0-9]*([._-][a-z0-9]+)*$", 2: r"^[a-z][a-z0-9-]*(\.[a-z0-9-]+)+$"}
_DEVICE = re.compile(r"(?i)(con|prn|aux|nul|com[1-9]|lpt[1-9])(\..*)?")


def path_ok(path: Any, version: int = 1) -> bool:
    """Whether a member path obeys the grammar of a version (2 is laxer)."""
    if not isinstance(path, str) or not path or path.startswith("/") or "\\" in path or unicodedata.normalize("NFC", path) != path:
        return False
    parts = path.split("/")
    if any(p in ("", ".", "..") for p in parts):
        return False
    if version == 2:
        return len(path.encode()) <= 512 and path != MANIFEST
    bad = any(p[-1] in ". " or _DEVICE.fullmatch(p) for p in parts)
    return len(path) <= 512 and ":" not in path and not re.search(r"[\x00-\x1f\x7f]", path) and not bad


def path_column(path: Column, version: int = 1) -> Column:
    """The grammar as an expression, but for Unicode normal form (texts beyond ASCII need :func:`path_ok`)."""
    good = (path != "") & ~path.rlike(r"\\|^/|//|/\z") & ~path.rlike(r"(^|/)\.{1,2}(/|\z)")  # a $ would also match before a last line separator
    if version == 2:
        return good & (F.octet_length(path) <= 512) & (path != MANIFEST)
    return (
        good & (F.char_length(path) <= 512) & ~path.rlike(r"[:\x00-\x1f\x7f]") & ~path.rlike(r"[. ](/|\z)")
        & ~path.rlike(r"(?i)(^|/)(con|prn|aux|nul|com[1-9]|lpt[1-9])(\.[^/]*)?(/|\z)")
    )


def _refuse(condition: Any, message: str) -> None:
    if condition:
        raise ArchiveFormatError(message)


def parse_manifest(data: bytes) -> dict[str, Any]:
    """JSON without duplicate keys, without non-finite numbers, of bounded size and nesting."""
    _refuse(len(data) > MAX_MANIFEST, "the manifest is too large")
    depth, quoted, skip = 0, False, False
    for c in data:  # before parsing, so that deep nesting cannot exhaust the parser
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == 0x5C, c != 0x22
        elif c == 0x22:
            quoted = True
        elif c in b"[{":
            depth += 1
            _refuse(depth > MAX_DEPTH, "the manifest is nested too deeply")
        elif c in b"]}":
            depth -= 1

    def unique(pairs: list) -> dict:
        _refuse(len({k for k, _ in pairs}) != len(pairs), "the manifest repeats a key")
        return dict(pairs)

    def number(text: str) -> None:
        raise ArchiveFormatError(f"the manifest holds {text}")

    try:
        out = json.loads(data.decode("utf-8"), object_pairs_hook=unique, parse_constant=number)
    except ValueError as error:
        raise ArchiveFormatError(f"the manifest is not JSON: {error}") from None
    _refuse(not isinstance(out, dict), "the manifest is not an object")
    return out


@dataclass(frozen=True)
class Entry:
    path: str
    size: int
    crc32: int
    offset: int
    start: int

    @property
    def end(self) -> int:
        return self.start + self.size


def preflight(data: bytes) -> list[Entry]:
    """The entries of a plain stored ZIP; anything beyond that profile is refused."""
    _refuse(len(data) < 22 or data[-22:-18] != b"PK\5\6", "no end record, or a comment behind it")
    disk, first, here, n, size, start, comment = struct.unpack("<4H2LH", data[-18:])
    _refuse(disk or first or here != n or comment, "several disks or a comment")
    _refuse(start + size != len(data) - 22, "the directory is not where the end record says")
    _refuse(n == 0 or n > MAX_ENTRIES + 1, "no entries or too many")
    entries, at, total = [], start, 0
    for _ in range(n):
        _refuse(data[at : at + 4] != b"PK\1\2" or at + 46 > len(data), "a damaged directory")
        (made, _need, flags, method, _t, _d, crc, packed, size, ln, le, lc, disk, _ia, attrs, offset) = struct.unpack("<6H3L5H2L", data[at + 4 : at + 46])
        name = data[at + 46 : at + 46 + ln]
        _refuse(flags & ~0x800 or method or packed != size or le or lc or disk, "an entry is not plainly stored")
        mode = attrs >> 16
        _refuse(made >> 8 == 3 and mode and mode & 0o170000 not in (0, 0o100000), "an entry is no regular file")
        _refuse(size > MAX_MEMBER, "a member is too large")
        total += size
        _refuse(total > MAX_TOTAL, "the members are too large together")
        _refuse(data[offset : offset + 4] != b"PK\3\4" or offset + 30 > start, "a damaged local header")
        lflags, lmethod, _lt, _ld, lcrc, lpacked, lsize, lln, lle = struct.unpack("<2H2H3L2H", data[offset + 6 : offset + 30])
        local = data[offset + 30 : offset + 30 + lln]
        _refuse((lflags, lmethod, lcrc, lpacked, lsize, lle, local) != (flags, method, crc, packed, size, 0, name), "local and central headers disagree")
        try:
            entries.append(Entry(name.decode("utf-8"), size, crc, offset, offset + 30 + lln))
        except UnicodeDecodeError:
            raise ArchiveFormatError("a name is not UTF-8") from None
        at += 46 + ln
    _refuse(at != len(data) - 22, "the directory has another size than stated")
    last = 0
    for e in sorted(entries, key=lambda e: e.offset):
        _refuse(e.offset != last or e.end > start, "entries overlap or leave gaps")
        last = e.end
    _refuse(last != start, "bytes between the members and the directory")
    names = [e.path for e in entries]
    _refuse(len(set(names)) != n or names.count(MANIFEST) != 1, "names repeat or the manifest is missing")
    return entries


def _keys(node: Any, keys: set[str], what: str) -> dict:
    _refuse(not isinstance(node, dict) or set(node) != keys, f"{what} must have exactly the keys {', '.join(sorted(keys))}")
    return node


def _refs(manifest: dict) -> list[tuple[str, str, dict]]:
    """(group, kind, reference) of every reference in the manifest."""
    out = [("replay", k, r) for k, rs in sorted(manifest["replay"].items()) for r in rs]
    return out + [("payloads", k, r) for k, rs in sorted(manifest["payloads"].items()) for r in rs]


def validate(manifest: dict) -> None:
    """All rules of the manifest itself; no payload byte is needed."""
    version = manifest.get("schema_version")
    _refuse(version not in PROFILE or isinstance(version, bool), f"schema version {version!r}")
    _keys({k: v for k, v in manifest.items() if k != "extensions"}, KEYS, "the manifest")
    _refuse(manifest["profile"] != PROFILE[version], "another profile")
    _refuse(not isinstance(manifest["archive_id"], str) or not re.fullmatch(ID, manifest["archive_id"]), "a bad archive id")
    _refuse(manifest["physical_profile"] != PHYSICAL or manifest["reader_dispatch"] != DISPATCH, "another physical profile or dispatch")
    _keys(manifest["writer"], {"name", "version"}, "writer")
    for name in manifest.get("extensions") or {}:
        _refuse(not re.fullmatch(NAMESPACE[version], name), f"a bad extension namespace {name!r}")
    inventory = manifest["member_inventory"]
    _refuse(not isinstance(inventory, list) or not 0 < len(inventory) <= MAX_ENTRIES, "the inventory is empty or too long")
    for row in inventory:
        _keys(row, ROW_KEYS, "an inventory row")
        _refuse(not path_ok(row["path"], version) or row["path"] == MANIFEST, f"unsafe member path {row['path']!r}")
        _refuse(row["regular_file"] is not True, "a member is no regular file")
        _refuse(not isinstance(row["raw_sha256"], str) or not re.fullmatch(SHA, row["raw_sha256"]), "a bad hash")
        size = row["uncompressed_size_bytes"]
        _refuse(isinstance(size, bool) or not isinstance(size, int) or not 0 <= size <= MAX_MEMBER, "a bad size")
    paths = [r["path"] for r in inventory]
    _refuse(len(set(paths)) != len(paths), "the inventory repeats a path")
    _refuse(sum(r["uncompressed_size_bytes"] for r in inventory) > MAX_TOTAL, "the members are too large together")
    _keys(manifest["replay"], set(REPLAY), "replay")
    _keys(manifest["payloads"], set(PAYLOADS), "payloads")
    own = {r["path"]: r for r in inventory}
    used = []
    for _group, kind, ref in _refs(manifest):
        extra = {"host_kind", "load_policy"} if kind == "host_artifacts" else set()
        _keys(ref, REF_KEYS | extra, f"a reference of {kind}")
        row = own.get(ref["member_path"])
        _refuse(row is None, f"{ref['member_path']!r} is referred to but not in the inventory")
        _refuse(any(row[k] != ref[k] for k in ("raw_sha256", "semantic_fingerprint", "semantic_profile")), "a reference differs from its inventory row")
        if kind == "host_artifacts" and ref["host_kind"] in UNSAFE_HOSTS:
            _refuse(ref["load_policy"] != "host_opt_in", "an unsafe host artifact needs host_opt_in")
        used.append(ref["member_path"])
    workspace = _workspace(manifest["workspace"], own)
    _refuse(set(used) | workspace != set(paths), "members that nothing refers to")
    _refuse(version == 2 and len(set(used)) != len(used), "a member is shared by references")
    if version == 2:
        _refuse(not manifest["payloads"]["model"], "version 2 needs a model")
        _refuse(bool(manifest["payloads"]["conformal"]), "version 2 holds no conformal payload")
    migration = manifest["migration_provenance"]
    if migration is not None:
        _keys(migration, {"source_archive_id", "source_sha256", "policy", "source_retained"}, "migration_provenance")
        _refuse(migration["policy"] != "copy_on_write" or migration["source_retained"] is not True, "a migration must copy and keep its source")
        _refuse(not re.fullmatch(SHA, str(migration["source_sha256"])), "a bad hash")
    security = _keys(manifest["security"], {"signature", "preimage_sha256"}, "security")
    _refuse(security["signature"] is not None, "signatures are reserved")
    _refuse(security["preimage_sha256"] not in (None, preimage_sha256(manifest)), "the preimage hash differs")


def _workspace(workspace: Any, own: dict) -> set[str]:
    """Paths of a workspace snapshot, after its rules."""
    held = {p for p in own if p.startswith("workspace/")}
    if workspace is None:
        _refuse(held, "workspace members without a workspace")
        return set()
    _keys(workspace, {"database", "run_ids", "inventory", "inventory_complete"}, "workspace")
    paths = workspace["inventory"]
    _refuse(workspace["inventory_complete"] is not True or not isinstance(paths, list) or set(paths) != held, "the workspace inventory is not complete")
    _refuse([p for p in paths if p.endswith(".sqlite")] != [workspace["database"]], "a workspace has exactly one database")
    live = re.compile(r"(\.lock|-wal|-shm|-journal|\.journal|\.tmp|~)$|/live-session/")
    _refuse(any(live.search(p) for p in paths), "a workspace holds live files")
    runs = tuple(f"workspace/{r}/" for r in workspace["run_ids"])
    _refuse(any(p != workspace["database"] and not p.startswith(runs) for p in paths), "a workspace file outside its runs")
    return held


def preimage_sha256(manifest: dict) -> str:
    """SHA-256 of the canonical manifest without its security figures."""
    bare = manifest | {"security": {"signature": None, "preimage_sha256": None}}
    return hashlib.sha256(json.dumps(bare, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


@dataclass(frozen=True)
class Archive:
    version: int
    manifest: dict[str, Any]
    members: dict[str, bytes]

    def view(self) -> dict[str, Any]:
        """A read-only projection: one row per payload, ordered, and what executing would need."""
        rows = [
            {"owner": f"{g}.{k}", **{x: r[x] for x in ("schema_id", "schema_version", "member_path", "raw_sha256", "semantic_fingerprint", "semantic_profile")}}
            for g, k, r in _refs(self.manifest)
        ]
        return {
            "archive_id": self.manifest["archive_id"], "schema_version": self.version, "persistence_kind": self.manifest["persistence_kind"],
            "payloads": rows, "execution_status": "requires_native_artifact_executor",
        }

    def predict(self, *_: Any) -> None:
        raise ArchiveUnsupported("an archive is not executed here")


def read(data: bytes, *, execute: bool = False) -> Archive:
    """Verify the bytes of an archive. With ``execute``, payloads that nothing executes are refused last."""
    entries = preflight(data)
    by_path = {e.path: e for e in entries}
    head = by_path[MANIFEST]
    manifest = parse_manifest(data[head.start : head.end])
    try:
        validate(manifest)
    except (AttributeError, KeyError, TypeError, ValueError, RecursionError) as error:
        # a value of another type than its rule expects
        raise ArchiveFormatError(f"a malformed manifest: {type(error).__name__} {error}") from error
    inventory = {r["path"]: r for r in manifest["member_inventory"]}
    _refuse(set(inventory) != set(by_path) - {MANIFEST}, "the inventory is not what the archive holds")
    members = {}
    for e in entries:
        content = data[e.start : e.end]
        if zlib.crc32(content) != e.crc32:
            raise ArchiveIntegrityError(f"{e.path}: another CRC-32")
        if e.path == MANIFEST:
            continue
        row = inventory[e.path]
        if len(content) != row["uncompressed_size_bytes"] or hashlib.sha256(content).hexdigest() != row["raw_sha256"]:
            raise ArchiveIntegrityError(f"{e.path}: another size or SHA-256 than stated")
        members[e.path] = content
    if execute:
        version = manifest["schema_version"]
        for kind, since in PAYLOADS.items():
            if manifest["payloads"][kind] and (since is None or version < since):
                raise ArchiveUnsupported(f"version {version} does not execute {kind}")
    return Archive(manifest["schema_version"], manifest, dict(sorted(members.items())))


def load(path: str | Path, *, execute: bool = False) -> Archive:
    """Verify a file; one that changes meanwhile is refused."""
    path = Path(path)
    data = path.read_bytes()
    out = read(data, execute=execute)
    if hashlib.sha256(path.read_bytes()).digest() != hashlib.sha256(data).digest():
        raise ArchiveIntegrityError("the archive changed while it was read")
    return out


def derive(manifest: dict, members: dict[str, bytes]) -> dict:
    """The manifest with inventory, hashes and sizes taken from the members' bytes."""
    out = json.loads(json.dumps(manifest))
    known = {r["path"]: r for r in out.get("member_inventory") or []}
    out["member_inventory"] = [
        {
            "path": path, "regular_file": True, "raw_sha256": hashlib.sha256(content).hexdigest(),
            "uncompressed_size_bytes": len(content),
            "semantic_fingerprint": known.get(path, {}).get("semantic_fingerprint"),
            "semantic_profile": known.get(path, {}).get("semantic_profile", "raw"),
        }
        for path, content in sorted(members.items())
    ]
    own = {r["path"]: r for r in out["member_inventory"]}
    for _, _, ref in _refs(out):
        row = own.get(ref["member_path"])
        _refuse(row is None, f"{ref['member_path']!r} is referred to but not given")
        ref |= {k: row[k] for k in ("raw_sha256", "semantic_fingerprint", "semantic_profile")}
    out["security"] = {"signature": None, "preimage_sha256": preimage_sha256(out)}
    return out


def template(archive_id: str, refs: dict[str, list[str]], version: int = 2) -> dict:
    """A manifest to :func:`derive` from: kinds of ``REPLAY`` or ``PAYLOADS`` with member paths."""
    def of(kind: str) -> list[dict]:
        return [
            {"schema_id": f"spectrine.{kind}", "schema_version": 1, "member_path": p, "raw_sha256": "", "semantic_fingerprint": None, "semantic_profile": "raw"}
            for p in refs.get(kind, [])
        ]

    return {
        "schema_version": version, "profile": PROFILE[version], "archive_id": archive_id, "persistence_kind": "portable",
        "writer": {"name": "spectrine", "version": "1"}, "reader_dispatch": DISPATCH, "physical_profile": PHYSICAL,
        "replay": {k: of(k) for k in REPLAY}, "payloads": {k: of(k) for k in PAYLOADS}, "member_inventory": [],
        "migration_provenance": None, "security": {"signature": None, "preimage_sha256": None}, "workspace": None,
    }


def pack(manifest: dict, members: dict[str, bytes]) -> bytes:
    """The bytes of an archive, after all checks."""
    manifest = derive(manifest, members)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for path, content in [(MANIFEST, json.dumps(manifest, sort_keys=True, indent=1, ensure_ascii=False).encode()), *sorted(members.items())]:
            info = zipfile.ZipInfo(path, (1980, 1, 1, 0, 0, 0))
            info.external_attr = 0o100644 << 16
            info.create_system = 3
            z.writestr(info, content)
    read(out.getvalue())
    return out.getvalue()


def write(path: str | Path, manifest: dict, members: dict[str, bytes]) -> None:
    """Publish in one step; an existing archive is never replaced."""
    path, data = Path(path), pack(manifest, members)
    fd, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    published = False
    try:
        with os.fdopen(fd, "wb") as out:
            out.write(data)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(name, path)
        except FileExistsError:
            raise ArchiveExists(f"{path} exists") from None
        published = True
    finally:
        try:
            os.unlink(name)
        except OSError as error:
            if published:
                raise PublishedWithCleanupError(str(error)) from error


_MEMBERS = (
    "archive string, path string, size long, crc32 long, sha256 string, local_offset long, data_end long, content binary, refusal_code string"
)


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """One row per member of every archive under ``path`` that passes the container checks.

    An archive that does not has one row, with null member columns and its ``refusal_code``.
    """
    names = [x.split()[0] for x in _MEMBERS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    entries = preflight(data)
                except ArchiveError as error:
                    yield pd.DataFrame([[name.rsplit("/", 1)[-1], *[None] * 7, error.code]], columns=names).astype(
                        {"size": "Int64", "crc32": "Int64", "local_offset": "Int64", "data_end": "Int64"}
                    )
                    continue
                for e in entries:
                    body = data[e.start : e.end]
                    yield pd.DataFrame(
                        [[name.rsplit("/", 1)[-1], e.path, e.size, e.crc32, hashlib.sha256(body).hexdigest(), e.offset, e.end, body, None]],
                        columns=names,
                    )

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, _MEMBERS)


def archive_report(spark: SparkSession, path: str, *, execute: bool = False) -> DataFrame:
    """(archive, schema_version, archive_id, refusal_code, message) of every archive; no code means it passed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                row = [name.rsplit("/", 1)[-1], None, None, None, None]
                try:
                    found = read(data, execute=execute)
                    row[1:3] = [found.version, found.manifest["archive_id"]]
                except ArchiveError as error:
                    row[3:] = [error.code, str(error)]
                rows.append(row)
            yield pd.DataFrame(rows, columns=["archive", "schema_version", "archive_id", "refusal_code", "message"]).astype({"schema_version": "Int32"})

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, "archive string, schema_version int, archive_id string, refusal_code string, message string")
