import datetime as dt
import gzip
import io
import json
import os
import tarfile

import pytest

from capturebase.plans import surfaces, views
from capturebase.sources import archives, ingest, remote
from capturebase.sources.archives import BadArchive, BadMember, project, read_archives, survey
from capturebase.sources.ledger import Ledger, Refused
from capturebase.sources.packages import MONTHLY, Ceilings, UnknownPackage, package

PUB = "http://publications.europa.eu/resource/schema/ted/R2.0.9/publication"
MONTH = "monthly/2023-11"


LEGACY_ROOT = f"{{{PUB}}}TED_EXPORT"


def legacy(n, year=2023, day="20231115", country="PL", codes=("79000000", "79100000"), ns=PUB, inner="", doc_id=None):
    cpv = "".join(f'<ORIGINAL_CPV CODE="{c}"/>' for c in codes)
    return f'<TED_EXPORT xmlns="{ns}" VERSION="R2.0.9.S05" DOC_ID="{doc_id or f"{n}-{year}"}"><CODED_DATA_SECTION{inner}><REF_OJS><DATE_PUB>{day}</DATE_PUB></REF_OJS><NOTICE_DATA><ISO_COUNTRY VALUE="{country}"/>{cpv}</NOTICE_DATA><CODIF_DATA><DS_DATE_DISPATCH>20231110</DS_DATE_DISPATCH></CODIF_DATA></CODED_DATA_SECTION></TED_EXPORT>'.encode()


def eforms(refs=(), buyer="ORG-2", day="2023-11-16Z", version="eforms-sdk-1.9", root="ContractNotice"):
    c = archives.NS
    orgs = "".join(f'<efac:Organization><efac:Company><cac:PostalAddress><cac:Country><cbc:IdentificationCode>{k}</cbc:IdentificationCode></cac:Country></cac:PostalAddress><cac:PartyIdentification><cbc:ID>{o}</cbc:ID></cac:PartyIdentification></efac:Company></efac:Organization>' for o, k in (("ORG-1", "FRA"), ("ORG-2", "DEU")))
    named = "".join(f'<efac:Changes><efbc:ChangedNoticeIdentifier schemeName="notice-id-ref">{v}</efbc:ChangedNoticeIdentifier></efac:Changes>' for v in refs)
    return f"""<r:{root} xmlns:r="urn:oasis:names:specification:ubl:schema:xsd:{root}-2" xmlns:cbc="{c['cbc']}" xmlns:cac="{c['cac']}" xmlns:efac="{c['efac']}" xmlns:efbc="{c['efbc']}">
<cbc:CustomizationID>{version}</cbc:CustomizationID><cbc:ID schemeName="notice-id">u-1</cbc:ID><cbc:IssueDate>2023-11-10+01:00</cbc:IssueDate><cbc:VersionID>01</cbc:VersionID>
<ext><efac:FieldsPrivacy><efbc:PublicationDate>1999-01-01Z</efbc:PublicationDate></efac:FieldsPrivacy>{named}{orgs}<efac:Publication><efbc:PublicationDate>{day}</efbc:PublicationDate></efac:Publication></ext>
<cac:ContractingParty><cac:Party><cac:PartyIdentification><cbc:ID>{buyer}</cbc:ID></cac:PartyIdentification></cac:Party></cac:ContractingParty>
<cac:ProcurementProject><cac:MainCommodityClassification><cbc:ItemClassificationCode>72000000</cbc:ItemClassificationCode></cac:MainCommodityClassification><cac:AdditionalCommodityClassification><cbc:ItemClassificationCode>72100000</cbc:ItemClassificationCode></cac:AdditionalCommodityClassification></cac:ProcurementProject></r:{root}>""".encode()


def archive(path, items, tail=b""):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for name, raw in items:
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            t.addfile(info, io.BytesIO(raw))
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(out.getvalue() + tail, mtime=0))
    return str(path)


def named(*raws):
    return dict(zip([f.split()[0] for f in archives.FIELDS.replace("\n", " ").split(", ")], project(*raws), strict=False))


def test_projection():
    got = named("000007_2023.xml", legacy(7, country="pl", inner=' xmlns=""'))
    assert (got["publication_year"], got["publication_number"], got["source_format"], got["schema_version"]) == (2023, 7, "legacy", "R2.0.9.S05")
    assert (got["publication_date"], got["dispatch_date_raw"], got["buyer_country_iso"], got["primary_cpv"], got["additional_cpv"]) == (dt.date(2023, 11, 15), "20231110", "PL", "79000000", ["79100000"])
    assert got["change_reference_status"] == "not_applicable"
    got = named("8-2023.xml", eforms(["9-2023", "9-2023"]))
    assert (got["publication_date"], got["publication_date_raw"], got["dispatch_date"], got["buyer_country"], got["buyer_country_iso"]) == (dt.date(2023, 11, 16), "2023-11-16Z", dt.date(2023, 11, 10), "DEU", "DE")
    assert (got["notice_uuid"], got["notice_version"], got["primary_cpv"], got["additional_cpv"], got["change_reference_status"]) == ("u-1", "01", "72000000", ["72100000"], "present")
    assert project("8-2023.xml", eforms(["9-2023", "9-2023"]))[-1] == [(0, "9-2023", "notice-id-ref"), (1, "9-2023", "notice-id-ref")]
    got = named("8-2023.xml", eforms(buyer="ORG-9"))
    assert (got["buyer_country"], got["buyer_country_status"], got["change_reference_status"]) == (None, "absent", "absent")
    assert named("8-2023.xml", legacy(8, country="", codes=()))["primary_cpv_status"] == "absent"


@pytest.mark.parametrize(
    ("code", "name", "raw"),
    [
        ("invalid_identity", "0_2023.xml", legacy(1)), ("identity_mismatch", "1_2023.xml", legacy(1, doc_id="2-2023")), ("unsupported_root", "1_2023.xml", legacy(1, ns="urn:x")),
        ("unsupported_root", "1_2023.xml", b"<TED_EXPORT/>"), ("unsupported_declaration", "1_2023.xml", b"<!doctype x><TED_EXPORT/>"), ("unsupported_encoding", "1_2023.xml", legacy(1).decode().encode("utf-16")),
        ("malformed_xml", "1_2023.xml", b"<a>"), ("missing_publication_date", "1_2023.xml", legacy(1, day=" ")), ("unparseable_date", "1_2023.xml", legacy(1, day="20231315")),
        ("empty_change_reference", "1_2023.xml", eforms([" "])), ("unsupported_customization", "1_2023.xml", eforms(version="x")), ("unsupported_customization", "1_2023.xml", eforms(version="eforms-sdk-" + "1" * 128)),
    ],
)
def test_rejects(code, name, raw):
    with pytest.raises(BadMember) as e:
        project(name, raw)
    assert e.value.code == code


def test_archive_faults(tmp_path):
    one = [("000001_2023.xml", legacy(1))]
    read = lambda path, limits=MONTHLY: [n for n, _ in archives.members(path, limits)]
    good = archive(tmp_path / "a.tar.gz", one)
    whole = open(good, "rb").read()
    assert read(good) == ["000001_2023.xml"] and read(archive(tmp_path / "n.tar.gz", [("d/i.tar.gz", whole)])) == ["d/i.tar.gz!000001_2023.xml"]
    deep = open(archive(tmp_path / "n2.tar.gz", [("i.tar.gz", whole)]), "rb").read()
    bad = {"short": whole[:-9], "sum": whole[:-8] + b"\1\2\3\4" + whole[-4:], "none": b"x"}
    for name, raw in bad.items():
        (tmp_path / name).write_bytes(raw)
        with pytest.raises(BadArchive):
            read(str(tmp_path / name))
    for items, tail in (([("../1_2023.xml", b"x")], b""), ([("c:1_2023.xml", b"x")], b""), (one, b"after"), (one + [("i.tar.gz", whole)], b""), ([("i.tar.gz", deep)], b"")):
        with pytest.raises(BadArchive):
            read(archive(tmp_path / "b.tar.gz", items, tail))
    link = tmp_path / "l.tar.gz"
    with tarfile.open(link, "w:gz") as t:
        info = tarfile.TarInfo("1_2023.xml")
        info.type, info.linkname = tarfile.SYMTYPE, "/etc/passwd"
        t.addfile(info)
    with pytest.raises(BadArchive):
        read(str(link))
    for k in ({"expanded_bytes": 1000, "member_bytes": 1000}, {"member_bytes": 10}, {"archive_bytes": 20, "container_bytes": 20}):
        with pytest.raises(BadArchive):
            read(good, Ceilings(**k))


def test_names():
    p = package("daily/202300220")
    assert (p.search, p.issue, p.path) == ("OJ = 220/2023", "220/2023", "daily/202300220") and p.stranger("221/2023", dt.date(2023, 1, 1))
    p = package("monthly/2020-02")
    assert (p.path, p.search, p.file) == ("monthly/2020-2", "PD>=20200201 AND PD<=20200229", "packages/monthly/2020-02.tar.gz")
    for bad in ("daily/202300000", "monthly/2020-13", "monthly/2020-2", "daily/202300220\n", "monthly/1889-01", "x", "monthly/../02"):
        with pytest.raises(UnknownPackage):
            package(bad)


class FakeClock(remote.Clock):
    def __init__(self):
        self.t, self.slept = 0.0, []

    def now(self):
        return self.t

    def sleep(self, s):
        self.t, self.slept = self.t + s, [*self.slept, s]


class FakeWeb:
    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def open(self, url, timeout, body=None):
        self.asked.append(body)
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        status, head, raw = a if isinstance(a, tuple) else (200, {}, a if isinstance(a, bytes) else json.dumps(a).encode())
        return status, head, io.BytesIO(raw).read


def page(numbers, total, token=None, day="2023-11-15+01:00", **more):
    notices = [{"publication-number": f"{n}-2023", "publication-date": day, "ojs-number": "220/2023"} for n in numbers]
    return {"notices": notices, "totalNoticeCount": total, "timedOut": False} | ({"iterationNextToken": token} if token else {}) | more


def test_search():
    p = package(MONTH)
    web = FakeWeb(page([1, 2], 3, "a"), page([3], 3, "b"), page([], 3, "c"))
    seen = remote.listing(p, web, FakeClock())
    assert seen.complete and seen.keys == {(2023, n) for n in (1, 2, 3)} and [b.get("iterationNextToken") for b in web.asked] == [None, "a", "b"]
    clock = FakeClock()
    assert remote.listing(p, FakeWeb((429, {"retry-after": "7"}, b""), remote.Passing("lost"), page([1], 1)), clock).calls == 3 and clock.slept == [7.0, 2.0]
    wrong = [
        [page([1], 2)], [page([1], 2, "a"), page([], 2)], [page([1], 2, "a"), page([2], 3)], [page([1], 3, "a"), page([2], 3, "a")], [page([1, 1], 2)], [page([1, 2], 1)], [page([1], 1, timedOut=True)],
        [page([1], 1, day="2023-12-01")], [page([1], 1, day="2023-11-15x")], [page([0], 1)], [page([1], True)], [page([1], 200_000)], [b"x"], [(404, {}, b"")], [(503, {}, b"")] * 3,
        [(429, {"retry-after": "9999"}, b"")], [(200, {"content-length": "9999999999"}, b"")], [page([1], 1, iterationNextToken=5)], [{"totalNoticeCount": 0, "timedOut": False}],
    ]
    for answers in wrong:
        with pytest.raises(remote.Unavailable) as e:
            remote.listing(p, FakeWeb(*answers), FakeClock())
        assert e.value.seen is not None and not e.value.seen.complete
    assert remote.retry_after("Wed, 21 Oct 2015 07:28:10 GMT", dt.datetime(2015, 10, 21, 7, 28, tzinfo=dt.UTC)) == 10 and remote.retry_after("soon", dt.datetime.now(dt.UTC)) is None


def test_download(tmp_path):
    p = package(MONTH)
    raw = open(archive(tmp_path / "src.tar.gz", [("000001_2023.xml", legacy(1))]), "rb").read()
    head = {"content-length": str(len(raw))}
    path, calls = remote.download(p, str(tmp_path / "d"), FakeWeb((200, head, raw[:50]), (200, head, raw)), FakeClock())
    assert calls == 2 and open(path, "rb").read() == raw and remote.download(p, str(tmp_path / "d"), FakeWeb()) == (path, 0)
    with pytest.raises(BadArchive):
        remote.download(p, str(tmp_path / "e"), FakeWeb((200, {}, b"junk")), FakeClock())
    assert [f for f in (tmp_path / "e").rglob("*") if f.is_file()] == []


def test_scan_survey_and_ledger(spark, tmp_path):
    good = archive(tmp_path / "a.tar.gz", [(f"00000{i}_2023.xml", legacy(i)) for i in (1, 2)])
    nested = archive(tmp_path / "n.tar.gz", [("inner.tar.gz", open(good, "rb").read())])
    bad = archive(tmp_path / "b.tar.gz", [("000003_2023.xml", legacy(3)), ("000004_2023.xml", b"<!DOCTYPE x><TED_EXPORT/>"), ("000005_2023.xml", b"<other/>"), ("x.xml", b"<a/>"), ("readme.txt", b"")])
    twice = archive(tmp_path / "t.tar.gz", [("a/000001_2023.xml", legacy(1)), ("b/1-2023.xml", legacy(1))])
    rows = read_archives(spark, [good, nested]).collect()
    assert len(rows) == 4 and {(r.publication_number, r.publication_year, r.buyer_country, r.primary_cpv, tuple(r.additional_cpv)) for r in rows} == {(i, 2023, "PL", "79000000", ("79100000",)) for i in (1, 2)}
    assert {(r.reject, r.members) for r in survey(read_archives(spark, [bad], "survey")).collect()} == {(None, 1), ("unsupported_declaration", 1), ("unsupported_root", 1), ("invalid_identity", 1), ("unsupported_member_name", 1)}
    assert {r.archive[-8]: r.loadable for r in archives.inspection(read_archives(spark, [good, bad, twice], "survey")).collect()} == {"a": True, "b": False, "t": False}
    raw = read_archives(spark, [nested, bad, twice], "survey")
    kinds = {(r.archive[-8:-7], r.category, r.value): r.members for r in archives.categories(raw).collect()}
    assert kinds["n", "format", "legacy"] == 2 and kinds["b", "unsupported_root", "other"] == 1 and kinds["b", "reason", "invalid_identity"] == 1 and kinds["t", "root", LEGACY_ROOT] == 2
    assert {(r.archive[-8:-7], r.what, r.sample) for r in archives.samples(raw).collect()} == {("b", "rejected", x) for x in ("000004_2023.xml unsupported_declaration", "000005_2023.xml unsupported_root", "x.xml invalid_identity", "readme.txt unsupported_member_name")} | {("t", "repeated", "1-2023")}
    assert {(r.archive[-8:-7], r.layout, r.containers, r.members) for r in archives.inspection(raw).collect()} == {("n", "nested", 1, 2), ("b", "flat", 0, 5), ("t", "flat", 0, 2)}
    assert {(r.sha256, r.compressed_bytes) for r in archives.facts(spark, [good]).collect()} == {(remote.sha256(good), os.path.getsize(good))}
    with pytest.raises(Exception, match="unsupported_declaration"):
        read_archives(spark, [bad]).collect()

    ledger = Ledger(spark, str(tmp_path / "ledger"))
    first = ledger.load(MONTH, "s1", good)
    assert ledger.load(MONTH, "s1", good) == first
    for sha, path in (("s2", bad), ("s3", twice)):
        with pytest.raises(Exception):
            ledger.load(MONTH, sha, path)
    assert ledger.visible().count() == 2
    second = ledger.load(MONTH, "s4", nested)
    assert second > first and [c["status"] for c in ledger.state()["capture"]] == ["superseded", "failed", "failed", "published"]

    def lost():
        raise OSError("no such machine")

    for _ in range(2):
        with pytest.raises(OSError):
            ledger.load(MONTH, "s5", lost)
    third = ledger.load(MONTH, "s5", good)
    assert third == second + 1 and "try=3" in ledger.row(ledger.state(), "capture", third)["spans"][0]["folder"]
    assert ledger.load(MONTH, "s5", good, force=True) == third + 1
    t = ledger.tables()
    assert surfaces.history(t).count() == 8 and t.capture.where("member_count = 2 and distinct_notice_count = 2").count() == 4 and surfaces.notices(t).count() == 2 and ledger.violations().isEmpty()


def test_resume_goes_on_after_the_committed_batches(spark, tmp_path, monkeypatch):
    from capturebase.sources import ledger as module

    monkeypatch.setattr(module, "BATCH", 2)
    monkeypatch.setattr(module, "SPAN", 2)
    path = archive(tmp_path / "a.tar.gz", [(f"{i:06d}_2023.xml", legacy(i)) for i in range(1, 11)])
    ledger, asked, read = Ledger(spark, str(tmp_path / "ledger")), [], module.read_archives

    def breaks(*a, **b):
        asked.append(b["first_batch"])
        if len(asked) == 2:
            raise OSError("the machine is gone")
        return read(*a, **b)

    monkeypatch.setattr(module, "read_archives", breaks)
    with pytest.raises(OSError):
        ledger.load(MONTH, "s", path)
    monkeypatch.setattr(module, "BATCH", 7)  # the batch size of the capture stays
    spark.createDataFrame([], "x int").write.parquet(str(tmp_path / "ledger/capture_id=1/try=1/first=2"))  # left behind, named by nothing
    new = ledger.load(MONTH, "s", path)
    c = ledger.row(ledger.state(), "capture", new)
    assert asked == [0, 2, 2, 4] and [(x["first"], x["members"], x["ends"], x["folder"][13:18]) for x in c["spans"]] == [(0, 4, False, "try=1"), (2, 4, False, "try=2"), (4, 2, True, "try=2")]
    assert (c["member_count"], c["batch_size"], ledger.visible().count(), {r.batch for r in ledger.visible().collect()}) == (10, 2, 10, set(range(5)))


def test_counts_that_disagree_are_refused(spark, tmp_path, monkeypatch):
    from capturebase.sources import ledger as module

    ledger, rows = Ledger(spark, str(tmp_path / "ledger")), Ledger._rows
    path = archive(tmp_path / "a.tar.gz", [("000001_2023.xml", eforms(["1-2023"])), ("000002_2023.xml", eforms([]))])
    for broken in (lambda df: df.limit(1), lambda df: df.withColumn("change_references", module.F.slice("change_references", 1, 0))):
        monkeypatch.setattr(Ledger, "_rows", lambda self, c, broken=broken: broken(rows(self, c)))
        with pytest.raises(Refused, match="reconcile"):
            ledger.load(MONTH, f"s{id(broken)}", path)
    monkeypatch.setattr(module, "_digest", lambda p, n=iter(range(9)): next(n))
    monkeypatch.setattr(Ledger, "_rows", rows)
    with pytest.raises(BadArchive, match="changed"):
        ledger.load(MONTH, "s", path)
    assert ledger.visible() is None


def test_what_passes_and_what_lasts(spark, tmp_path):
    from py4j.protocol import Py4JNetworkError
    from pyspark.errors import PySparkException

    from capturebase.sources.ledger import passing

    def caught(f):
        with pytest.raises(Exception) as e:
            f()
        return e.value

    bad = archive(tmp_path / "b.tar.gz", [("x.xml", b"<a/>")])
    lasting = [caught(lambda: read_archives(spark, [bad]).collect()), caught(lambda: spark.sql("select nothing")), caught(lambda: spark.sql("selec")), Refused("x"), ValueError("x"), BadArchive("x")]
    assert [passing(e) for e in lasting] == [False] * len(lasting)
    assert all(passing(e) for e in (OSError("disk"), ConnectionError(), TimeoutError(), remote.Unavailable("down"), Py4JNetworkError("gone"), PySparkException("Job aborted: ExecutorLostFailure")))


def test_migrations(spark, tmp_path):
    root = tmp_path / "ledger"
    root.mkdir()
    old = {"layout": 1, "capture": [{"capture_id": 1, "status": "published", "folder": "f", "loaded_row_count": 2}]} | {t: [] for t in ("published", "attempt", "run", "checkpoint")}
    (root / "CURRENT.json").write_text(json.dumps(old))
    ledger = Ledger(spark, str(root))
    assert ledger.state()["migrations"] == [1, 2] and ledger.state()["capture"][0]["spans"][0]["folder"] == "f" and ledger.migrate() == []
    for bad in ([1, 2, 3], [2]):
        (root / "CURRENT.json").write_text(json.dumps(ledger._read() | {"migrations": bad}))
        with pytest.raises(Refused):
            Ledger(spark, str(root))
        (root / "CURRENT.json").write_text(json.dumps(old))
        ledger = Ledger(spark, str(root))


def test_ingest(spark, tmp_path):
    ledger, data = Ledger(spark, str(tmp_path / "ledger")), str(tmp_path / "data")
    archive(tmp_path / "data/packages" / f"{MONTH}.tar.gz", [("000001_2023.xml", legacy(1)), ("000002_2023.xml", eforms(["1-2023"]))])
    listed = lambda *numbers: lambda p: remote.listing(p, FakeWeb(page(numbers, len(numbers))), FakeClock())
    r = ingest.ingest(ledger, MONTH, data, listed=listed(1, 3))
    assert (r.outcome, r.phase) == ("incomplete", "capture_published"), r.error
    a = ledger.state()["attempt"][-1]
    assert (a["state"], a["only_local_sample"], a["only_api_sample"]) == ("mismatch", ["2-2023"], ["3-2023"])

    def down(p):
        raise remote.Unavailable("down")

    assert ingest.ingest(ledger, MONTH, data, listed=down).outcome == "incomplete"
    r = ingest.ingest(ledger, MONTH, data, listed=listed(1, 2))
    assert (r.outcome, r.resumed, r.notice_count, r.checkpoint_is_current) == ("processed", True, 2, True)
    assert ingest.ingest(ledger, MONTH, data, listed=down).outcome == "replayed"
    assert [a["state"] for a in ledger.state()["attempt"]] == ["mismatch", "unavailable", "verified"] and ledger.violations().isEmpty()
    assert [(x.ordinal, x.value) for x in ledger.tables().reference.collect()] == [(0, "1-2023")]
    t = ledger.tables()
    for name, df in views.views(t).items():
        assert df.count() == {"notice_change_reference_history": 1, "capture_status": 1, "verification_attempt": 3, "ingest_run": 1, "package_ingest_status": 1}.get(name, 2)
    assert views.sql(spark, t, "select publication_ref from distinct_notice where source_coverage_verified and buyer_country_iso = :c", c="DE").collect() == [("2-2023",)]
    assert views.sql(spark, t, "select verification_state, open_run_id from ingest_run join package_ingest_status using (source_package_id)").collect() == [("verified", None)]
    #: A later check that fails retires the checkpoint; a new run seals it again.
    assert ledger.verify(r.capture_id, down)["state"] == "unavailable" and not ingest.status(ledger, MONTH)["checkpoint_is_current"]
    again = ingest.ingest(ledger, MONTH, data, listed=listed(1, 2))
    assert again.outcome == "processed" and again.run_id > r.run_id and again.capture_id == r.capture_id
    with ledger.locked(MONTH), pytest.raises(Refused):
        ingest.ingest(ledger, MONTH, data, wait=False)
    #: A month with a notice of another month is not compared at all.
    archive(tmp_path / "data/packages/monthly/2023-12.tar.gz", [("000001_2023.xml", legacy(1))])
    assert "asked" in ingest.ingest(ledger, "monthly/2023-12", data, listed=listed(1)).error
    archive(tmp_path / "data/packages/monthly/2024-01.tar.gz", [("a/1_2023.xml", legacy(1)), ("b/1_2023.xml", legacy(1))])
    r = ingest.ingest(ledger, "monthly/2024-01", data, listed=listed(1))
    assert (r.outcome, r.phase) == ("failed", "failed") and "reconcile" in r.error


def test_manifest(tmp_path):
    entry = lambda k, name: {"order": k, "source_package_id": name, "notice_count_observed": 1, "compressed_bytes_observed": 1, "observed_at": "2024-01-01", "purpose": "x"}
    good = {"manifest_version": 1, "packages": [entry(1, MONTH), entry(2, "daily/202300220"), entry(3, "monthly/2023-12")]}
    entries = ingest.manifest(good)
    for bad in ({}, good | {"x": 1}, good | {"manifest_version": True}, good | {"packages": []}, good | {"packages": [entry(2, MONTH)]}, good | {"packages": [entry(1, MONTH), entry(2, MONTH)]}, good | {"packages": [entry(1, "x")]}, good | {"packages": [entry(1, MONTH) | {"purpose": " "}]}, good | {"packages": [entry(1, MONTH) | {"order": True}]}):
        with pytest.raises(ingest.BadManifest):
            ingest.manifest(bad)

    def one(name):
        if name.startswith("daily"):
            raise OSError("gone")
        return ingest.Result(name, "processed", "completed", checkpoint_is_current=True)

    report = ingest.run_manifest(entries, one)
    assert (report["status"], report["failed_entry"], len(report["entries"])) == ("failed", "daily/202300220", 2)
    ingest.write_report(str(tmp_path / "r.json"), report)
    assert json.load(open(tmp_path / "r.json"))["entries"][1]["error"] == "OSError: gone" and len(list(tmp_path.iterdir())) == 1


def test_intake(spark, tmp_path):
    from capturebase.streaming.intake import intake

    ledger, told = Ledger(spark, str(tmp_path / "ledger")), []
    archive(tmp_path / "in/2023-11.tar.gz", [("000001_2023.xml", legacy(1))])
    archive(tmp_path / "in/2023-12.tar.gz", [("x.xml", b"")])
    go = lambda: intake(ledger, str(tmp_path / "in"), str(tmp_path / "cp"), lambda p: "monthly/" + p[-14:-7], lambda p, e: told.append(p[-14:-7])).awaitTermination(60)
    assert go() and told == ["2023-12"] and ledger.visible().count() == 1
    archive(tmp_path / "in/2024-01.tar.gz", [("000001_2024.xml", legacy(1, 2024))])
    assert go() and ledger.visible().count() == 2
