"""From a package's name to a sealed checkpoint, and manifests of packages in order. What a run has reached is recorded, so that the next
one goes on from there; a package that is already sealed and whose archive is still the same is no work."""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import json
import os
import tempfile
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, fields

from pyspark.sql import functions as F

from capturebase.plans.surfaces import package_status

from . import remote
from .archives import CONTRACT
from .ledger import REASON, Ledger, Refused, passing
from .packages import Package, package

SHOWN_ERROR = 2000


@dataclass(frozen=True)
class Result:
    """What became of one package."""

    source_package_id: str
    outcome: str
    phase: str
    run_id: int | None = None
    capture_id: int | None = None
    verification_attempt_id: int | None = None
    notice_count: int | None = None
    checkpoint_is_current: bool = False
    resumed: bool = False
    http_attempts: int = 0
    error: str | None = None


def status(ledger: Ledger, name: str) -> dict | None:
    """The package's row of the status surface."""
    row = package_status(ledger.tables()).where(F.col("source_package_id") == name).first()
    return None if row is None else row.asDict()


def _replay(ledger: Ledger, p: Package, path: str) -> Result | None:
    now = status(ledger, p.name)
    if not now or not now["checkpoint_is_current"]:
        return None
    sealed = ledger.row(ledger.state(), "checkpoint", p.name)
    if sealed["contract_version"] != CONTRACT or not remote.sound(path, p, sealed["artifact_sha256"]):
        return None
    return Result(p.name, "replayed", "completed", sealed["run_id"], sealed["capture_id"], sealed["verification_attempt_id"], sealed["notice_count"], True, True)


def ingest(ledger: Ledger, name: str, data: str, fetch: Callable[[Package, str], tuple[str, int]] = remote.download, listed: Callable[[Package], remote.Listing] = remote.listing, wait: bool = True) -> Result:
    """Archive, capture, verification and checkpoint of one package, under its lock. ``fetch`` gives the archive's path below ``data`` and
    the calls that took. The outcome is replayed, processed, incomplete (to be resumed) or failed (the run is over)."""
    p = package(name)
    with ledger.locked(name, wait):
        path = os.path.join(data, p.file)
        done = _replay(ledger, p, path)
        if done:
            return done
        run_id, resumed = ledger.open_run(name)
        calls = 0
        try:
            path, calls = fetch(p, data)
            sha = remote.sha256(path)
            run = ledger.row(ledger.state(), "run", run_id)
            if run["phase"] == "starting" or run.get("artifact_sha256") != sha:
                ledger.advance(run_id, phase="artifact_ready", artifact_path=path, artifact_sha256=sha, artifact_bytes=os.path.getsize(path), capture_id=None, verification_attempt_id=None)
            capture_id = ledger.load(name, sha, path)
            state = ledger.state()
            run, capture = ledger.row(state, "run", run_id), ledger.row(state, "capture", capture_id)
            #: An attempt of another capture, or one that no longer stands, is dropped.
            if run.get("capture_id") != capture_id or not capture["coverage_verified"]:
                ledger.advance(run_id, phase="capture_published", capture_id=capture_id, verification_attempt_id=None)
            latest = max((a for a in state["attempt"] if a["capture_id"] == capture_id), key=lambda a: a["attempt_id"], default=None)
            if latest is None or latest["state"] != "verified" or not capture["coverage_verified"]:
                latest = ledger.verify(capture_id, listed)
                calls += latest.get("http_attempts") or 0
            if latest["state"] != "verified":
                ledger.advance(run_id, last_error=f"{latest['state']}: {latest['reason']}"[:REASON])
                return Result(name, "incomplete", "capture_published", run_id, capture_id, latest["attempt_id"], None, False, resumed, calls, latest["reason"])
            ledger.advance(run_id, phase="source_verified", verification_attempt_id=latest["attempt_id"])
            sealed = ledger.seal(run_id)
        except Exception as e:
            return _over(ledger, run_id, name, e, resumed, calls)
        now = status(ledger, name)
        if not now or not now["checkpoint_is_current"]:
            raise Refused(f"{name}: the checkpoint doesn't read back as current")
        return Result(name, "processed", "completed", run_id, sealed["capture_id"], sealed["verification_attempt_id"], sealed["notice_count"], True, resumed, calls)


def _over(ledger: Ledger, run_id: int, name: str, e: Exception, resumed: bool, calls: int) -> Result:
    text = f"{type(e).__name__}: {e}"[:SHOWN_ERROR]
    going = passing(e)
    ledger.advance(run_id, last_error=text, **({} if going else {"phase": "failed"}))
    run = ledger.row(ledger.state(), "run", run_id)
    return Result(name, "incomplete" if going else "failed", run["phase"], run_id, run.get("capture_id"), run.get("verification_attempt_id"), None, False, resumed, calls, text)


# Manifests ------------------------------------------------------------------------------------------------------------------------------


class BadManifest(ValueError):
    pass


@dataclass(frozen=True)
class Entry:
    """One package of a manifest; all but its name is for planning."""

    order: int
    source_package_id: str
    notice_count_observed: int
    compressed_bytes_observed: int
    observed_at: str
    purpose: str


def manifest(document: object) -> list[Entry]:
    """The entries of a decoded manifest: {"manifest_version": 1, "packages": [...]}, each with the keys of Entry and no others."""

    def need(ok: bool, why: str) -> None:
        if not ok:
            raise BadManifest(why)

    need(isinstance(document, dict) and set(document) == {"manifest_version", "packages"}, "the keys are manifest_version and packages")
    need(type(document["manifest_version"]) is int and document["manifest_version"] == 1, "the version is 1")
    need(isinstance(document["packages"], list) and len(document["packages"]) > 0, "packages is a list with entries")
    kinds = {"int": int, "str": str}
    for k, e in enumerate(document["packages"], 1):
        need(isinstance(e, dict) and set(e) == {f.name for f in fields(Entry)}, f"entry {k}: other keys than those of an entry")
        need(all(type(e[f.name]) is kinds[f.type] for f in fields(Entry)), f"entry {k}: a value of another type")
        need(e["order"] == k, f"entry {k}: the order is not the position")
        need(min(e["notice_count_observed"], e["compressed_bytes_observed"]) >= 0 and bool(e["purpose"].strip()), f"entry {k}: a negative number or no purpose")
        try:
            package(e["source_package_id"])
            dt.date.fromisoformat(e["observed_at"])
        except ValueError as x:
            raise BadManifest(f"entry {k}: {x}") from x
    names = [e["source_package_id"] for e in document["packages"]]
    need(len(set(names)) == len(names), "a package comes twice")
    return [Entry(**e) for e in document["packages"]]


def digest(entries: list[Entry]) -> str:
    return hashlib.sha256(json.dumps([asdict(e) for e in entries], sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def run_manifest(entries: list[Entry], one: Callable[[str], Result]) -> dict:
    """Runs ``one`` for each package in order and stops at the first that isn't sealed; later ones are not tried. Returns the report."""
    began, clock, done, failed = dt.datetime.now(dt.UTC), time.monotonic(), [], None
    for e in entries:
        try:
            r = one(e.source_package_id)
        except Exception as x:
            r = Result(e.source_package_id, "error", "unknown", error=f"{type(x).__name__}: {x}"[:SHOWN_ERROR])
        done.append({"order": e.order} | asdict(r))
        if not (r.checkpoint_is_current and r.outcome in ("processed", "replayed")):
            failed = e.source_package_id
            break
    return {"report_version": 1, "manifest_sha256": digest(entries), "package_count": len(entries), "started_at": began.isoformat(), "duration_seconds": time.monotonic() - clock, "status": "failed" if failed else "completed", "failed_entry": failed, "entries": done}


def write_report(path: str, report: dict) -> None:
    """In one step, into a folder that exists."""
    handle, new = tempfile.mkstemp(".tmp", dir=os.path.dirname(os.path.abspath(path)))
    try:
        with os.fdopen(handle, "w") as f:
            json.dump(report, f, indent=2)
            f.flush()
            os.fsync(f.fileno())
        os.replace(new, path)
    finally:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(new)
