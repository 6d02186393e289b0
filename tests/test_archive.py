import io
import json
import struct
import zipfile
from copy import deepcopy

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spectrine.errors import ArchiveError, ArchiveExists, ArchiveFormatError, ArchiveIntegrityError, ArchiveUnsupported
from spectrine.sources import archive as A

MEMBERS = {"models/a.bin": b"model", "package.json": b"{}"}
REFS = {"model": ["models/a.bin"], "package": ["package.json"]}


def build(version=2, refs=REFS, members=MEMBERS, **change):
    return A.pack(A.template("run:1", refs, version) | change, members)


@pytest.mark.parametrize("version", [1, 2])
def test_round_trip(tmp_path, version):
    path = tmp_path / "a.zip"
    A.write(path, A.template("run:1", REFS, version), MEMBERS)
    got = A.load(path)
    assert got.members == MEMBERS and got.version == version
    assert [p["owner"] for p in got.view()["payloads"]] == ["replay.package", "payloads.model"]
    with pytest.raises(ArchiveExists):
        A.write(path, A.template("run:1", REFS, version), MEMBERS)
    with pytest.raises(ArchiveUnsupported):
        got.predict()
    if version == 1:
        with pytest.raises(ArchiveUnsupported):
            A.load(path, execute=True)
    else:
        assert A.load(path, execute=True).members == MEMBERS


def test_tampering():
    data = build()
    at = data.index(b"PK\3\4", 10)
    body = data.index(b"model", at + 30 + len("models/a.bin"))
    with pytest.raises(ArchiveIntegrityError):
        A.read(data[:body] + b"MODEL" + data[body + 5 :])
    for bad in (data[:-1], data + b"x", data[1:], b"", data.replace(b"PK\5\6", b"PK\5\7")):
        with pytest.raises(ArchiveFormatError):
            A.read(bad)


def test_compressed_or_extra_members(tmp_path):
    path = tmp_path / "z.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(A.MANIFEST, "{}" * 50)
    with pytest.raises(ArchiveFormatError):
        A.load(path)
    manifest = A.derive(A.template("run:1", REFS), MEMBERS)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for name, content in [(A.MANIFEST, json.dumps(manifest)), *MEMBERS.items(), ("stray", b"")]:
            info = zipfile.ZipInfo(name)
            info.external_attr = 0o100644 << 16
            z.writestr(info, content)
    with pytest.raises(ArchiveFormatError, match="inventory"):
        A.load(path)


def mutate(manifest, path, value):
    node = manifest
    for key in path[:-1]:
        node = node[key]
    node[path[-1]] = value
    return manifest


@pytest.mark.parametrize(
    ("path", "value"),
    [
        (["schema_version"], 3), (["schema_version"], True), (["profile"], "other"), (["archive_id"], "bad id"), (["unknown"], 1),
        (["writer", "status"], "x"), (["physical_profile", "compression"], "deflate"), (["reader_dispatch"], {}),
        (["member_inventory", 0, "path"], "a\\b"), (["member_inventory", 0, "path"], "../a"), (["member_inventory", 0, "regular_file"], False),
        (["member_inventory", 0, "raw_sha256"], "00"), (["member_inventory", 0, "uncompressed_size_bytes"], -1),
        (["member_inventory", 0, "uncompressed_size_bytes"], A.MAX_MEMBER + 1), (["payloads", "model"], []),
        (["payloads", "model", 0, "raw_sha256"], "0" * 64), (["payloads", "model", 0, "member_path"], "none"),
        (["security", "signature"], "s"), (["security", "preimage_sha256"], "0" * 64),
        (["migration_provenance"], {"source_archive_id": "a", "source_sha256": "0" * 64, "policy": "move", "source_retained": True}),
        (["workspace"], {"database": "w", "run_ids": [], "inventory": [], "inventory_complete": True}), (["extensions"], {"Bad": 1}),
    ],
)
def test_manifest_refusals(path, value):
    manifest = A.derive(A.template("run:1", REFS), MEMBERS)
    A.validate(manifest)
    with pytest.raises(ArchiveFormatError):
        A.validate(mutate(manifest, path, value))


def test_host_artifacts_and_sharing():
    manifest = A.template("run:1", REFS | {"host_artifacts": ["x.pkl"]}, 1)
    manifest["payloads"]["host_artifacts"][0] |= {"host_kind": "pickle", "load_policy": "native"}
    with pytest.raises(ArchiveFormatError, match="opt_in"):
        A.pack(manifest, MEMBERS | {"x.pkl": b""})
    manifest["payloads"]["host_artifacts"][0]["load_policy"] = "host_opt_in"
    A.pack(manifest, MEMBERS | {"x.pkl": b""})
    with pytest.raises(ArchiveFormatError, match="shared"):
        build(refs={"model": ["models/a.bin"], "package": ["package.json", "package.json"]})


def test_workspace():
    members = MEMBERS | {"workspace/db.sqlite": b"d", "workspace/r1/a.parquet": b"p"}
    good = {"database": "workspace/db.sqlite", "run_ids": ["r1"], "inventory": ["workspace/db.sqlite", "workspace/r1/a.parquet"], "inventory_complete": True}
    assert A.read(build(1, members=members, workspace=good)).version == 1
    for change in ({"run_ids": []}, {"inventory_complete": False}, {"database": "workspace/other.sqlite"}, {"inventory": []}):
        with pytest.raises(ArchiveFormatError):
            build(1, members=members, workspace=good | change)
    live = members | {"workspace/r1/a-wal": b""}
    with pytest.raises(ArchiveFormatError):
        build(1, members=live, workspace=good | {"inventory": [*good["inventory"], "workspace/r1/a-wal"]})


@pytest.mark.parametrize("text", ['{"a":1,"a":2}', "[" * 70 + "]" * 70, '{"a":NaN}', "[]", "{", '{"a":"\\' + "x"])
def test_strict_json(text):
    with pytest.raises(ArchiveFormatError):
        A.parse_manifest(text.encode())


def test_path_grammar(spark):
    from pyspark.sql import functions as F

    paths = ["a", "a/b.c", "", "/a", "a//b", "a/../b", ".", "a\\b", "a:b", "a.", "a ", "con", "x/LPT1.txt", "comx", "a\x01", "x" * 513, A.MANIFEST]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for version in (1, 2):
        got = [r[0] for r in df.select(A.path_column(F.col("p"), version)).collect()]
        assert got == [A.path_ok(p, version) for p in paths]
    assert not A.path_ok("é") and A.path_ok("é")


def test_tables_of_archives(spark, tmp_path):
    (tmp_path / "good.zip").write_bytes(build())
    bad = bytearray(build())
    bad[bad.index(b"model", bad.index(b"models/a.bin{") + 20 if b"models/a.bin{" in bad else bad.index(b"PK\3\4", 10))] ^= 1
    (tmp_path / "bad.zip").write_bytes(b"nothing")
    report = {r.archive: r.refusal_code for r in A.archive_report(spark, str(tmp_path)).collect()}
    assert report == {"good.zip": None, "bad.zip": "format"}
    members = A.archive_members(spark, str(tmp_path)).collect()
    assert {(m.path, m.size) for m in members} >= {("models/a.bin", 5), ("package.json", 2)}
    assert [(m.archive, m.path, m.refusal_code) for m in members if m.refusal_code] == [("bad.zip", None, "format")]
    assert struct.calcsize("<Q") == 8


def raw(manifest, members=MEMBERS):
    """An archive with the manifest as it stands."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, content in [(A.MANIFEST, json.dumps(manifest)), *members.items()]:
            info = zipfile.ZipInfo(name)
            info.external_attr = 0o100644 << 16
            z.writestr(info, content)
    return out.getvalue()


ODD = st.sampled_from([None, True, 0, -1, 1.5, "", "x", [], [1], {}, {"a": [None]}, [[{}]]])


def spots(value, at=()):
    """The ways to every value inside a document."""
    inner = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    return [at] * bool(at) + [s for k, v in inner for s in spots(v, (*at, k))]


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_mutated_manifests_are_judged_not_crashed_on(data):
    manifest = json.loads(json.dumps(A.derive(A.template("run:1", REFS, data.draw(st.sampled_from([1, 2]))), MEMBERS)))
    for _ in range(data.draw(st.integers(1, 3))):
        way = data.draw(st.sampled_from(spots(manifest)))
        inner = manifest
        for step in way[:-1]:
            inner = inner[step]
        inner[way[-1]] = deepcopy(data.draw(ODD))
    try:
        A.read(raw(manifest))
    except ArchiveError:
        pass
