"""The ledger: captures, published pointers, attempts to verify, runs and checkpoints.

Rows of a capture are written by executors to a folder of their own, which nothing reads until one small file, swapped atomically, names it.
That file holds a few entries a package, never notices. A reader resolves it once, so it sees one version of everything. File locks and the
swap hold on one host with one shared file system; that is the limit of this protocol.
"""

from __future__ import annotations

import datetime as dt
import fcntl
import hashlib
import json
import os
import re
from collections.abc import Callable
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, ArithmeticException, DateTimeException, IllegalArgumentException, NumberFormatException, ParseException, PySparkException, PySparkTypeError, PySparkValueError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from capturebase.operators.relational import uncommitted
from capturebase.operators.validators import attempt_violations, capture_violations, duplicate_identities, run_violations
from capturebase.plans.surfaces import Tables

from .archives import BATCH, CONTRACT, FIELDS, NOT_OF_A_NOTICE, BadArchive, read_archives
from .packages import Package, package
from .remote import VERSION, Listing, Unavailable

SPAN = 20  # batches that one job writes and commits together
OPEN = ("starting", "artifact_ready", "capture_published", "source_verified")
SHOWN, REASON = 20, 2000
RECIPE = "sha256 of year:number of all keys, sorted, one a line"
SCHEMAS = {
    "capture": "capture_id long, source_package_id string, acquisition_ordinal long, artifact_sha256 string, contract_version string, status string, coverage_verified boolean, member_count long, distinct_notice_count long, loaded_row_count long, batch_size long, artifact_bytes long, failure_reason string, acquired_at timestamp, published_at timestamp",
    "published": "source_package_id string, capture_id long",
    "attempt": "attempt_id long, capture_id long, artifact_sha256 string, contract_version string, verifier_version string, query_text string, query_scope string, state string, reason string, started_at timestamp, finished_at timestamp, announced_total long, api_record_count long, api_distinct_count long, api_duplicate_count long, local_distinct_count long, only_local_count long, only_api_count long, only_local_sample array<string>, only_api_sample array<string>, pages_fetched long, http_attempts long, api_keys_sha256 string, key_digest_recipe string",
    "run": "run_id long, source_package_id string, attempt_ordinal long, phase string, artifact_path string, artifact_sha256 string, artifact_bytes long, capture_id long, verification_attempt_id long, started_at timestamp, updated_at timestamp, completed_at timestamp, last_error string",
    "checkpoint": "source_package_id string, run_id long, capture_id long, verification_attempt_id long, artifact_sha256 string, contract_version string, notice_count long, sealed_at timestamp",
}
KEYS = {"capture": "capture_id", "published": "source_package_id", "attempt": "attempt_id", "run": "run_id", "checkpoint": "source_package_id"}
TIMES = {"acquired_at", "published_at", "started_at", "finished_at", "updated_at", "completed_at", "sealed_at"}


def _spans_of_folders(state: dict) -> None:
    """Captures written before there were batches are one span each, of the folder that they named."""
    for c in state["capture"]:
        folder, n = c.pop("folder", None), c.get("loaded_row_count")
        c.setdefault("spans", [] if folder is None or n is None else [{"first": 0, "last": 0, "folder": folder, "members": n, "references": None, "ends": True}])
        c.setdefault("batch_size", None)


#: Changes of the ledger's layout, in order; each is applied once, in a step of its own, and there is no way back.
MIGRATIONS = {1: lambda state: None, 2: _spans_of_folders}


class Refused(ValueError):
    """What was asked for is not allowed in the ledger's present state, or the rows don't reconcile."""


#: Errors of Spark that the same plan over the same data meets again.
LASTING = (AnalysisException, ArithmeticException, DateTimeException, IllegalArgumentException, NumberFormatException, ParseException, PySparkTypeError, PySparkValueError)


def passing(e: Exception) -> bool:
    """Whether the machines or the publisher failed, so that the same work may succeed later; else it is about the package or the plan. What a
    worker raises arrives as text in an error of Spark, after the last of its tries; of these only BadArchive is about the package."""
    if isinstance(e, LASTING):
        return False
    if isinstance(e, (PySparkException, Py4JError)):
        return re.search(rf"\b{BadArchive.__name__}\b", str(e)) is None
    return isinstance(e, (OSError, Unavailable))


def _digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _now() -> str:
    return dt.datetime.now(dt.UTC).isoformat()


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.file = spark, root, os.path.join(root, "CURRENT.json")
        os.makedirs(root, exist_ok=True)
        self.migrate()

    # State -------------------------------------------------------------------------------------------------------------------------

    def _read(self) -> dict:
        if not os.path.exists(self.file):
            return {"migrations": sorted(MIGRATIONS)} | {t: [] for t in SCHEMAS}
        with open(self.file) as f:
            state = json.load(f)
        state.setdefault("migrations", list(range(1, state.pop("layout", 1) + 1)))
        unknown = sorted(set(state["migrations"]) - set(MIGRATIONS))
        if unknown:
            raise Refused(f"the ledger has migrations that are not known here: {unknown}")
        return state

    def state(self) -> dict:
        state = self._read()
        if pending := sorted(set(MIGRATIONS) - set(state["migrations"])):
            raise Refused(f"the ledger lacks migrations {pending}")
        return state

    def migrate(self) -> list[int]:
        """Applies what the ledger lacks, in order, and returns it. A gap before what it has is refused: it can't be filled any more."""
        done = []
        with self.locked("state"):
            for version in sorted(MIGRATIONS):
                state = self._read()
                if version in state["migrations"]:
                    continue
                if version < max(state["migrations"], default=0):
                    raise Refused(f"migration {version} is missing before {max(state['migrations'])}")
                MIGRATIONS[version](state)
                self._write(state | {"migrations": [*state["migrations"], version]})
                done.append(version)
        return done

    def _write(self, state: dict) -> None:
        with open(new := self.file + ".new", "w") as f:
            json.dump(state, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(new, self.file)

    @contextmanager
    def locked(self, name: str, wait: bool = True):
        """One holder at a time for each name; packages don't wait for one another."""
        with open(os.path.join(self.root, f".lock-{name.replace('/', '-')}"), "w") as f:
            try:
                fcntl.flock(f, fcntl.LOCK_EX | (0 if wait else fcntl.LOCK_NB))
            except BlockingIOError:
                raise Refused(f"{name} is being worked on") from None
            yield

    @contextmanager
    def change(self):
        """The state, to be changed in place; all of it takes effect at the end, or nothing."""
        with self.locked("state"):
            yield (state := self.state())
            self._write(state)

    @staticmethod
    def row(state: dict, table: str, key: object) -> dict | None:
        return next((r for r in state[table] if r[KEYS[table]] == key), None)

    @staticmethod
    def add(state: dict, table: str, /, **values: object) -> int:
        """Appends a row under the next number, and returns that."""
        new = max((r[KEYS[table]] for r in state[table]), default=0) + 1
        state[table].append({KEYS[table]: new} | values)
        return new

    @staticmethod
    def put(state: dict, table: str, /, **values: object) -> None:
        """Replaces the row of the same key, or adds it."""
        state[table] = [r for r in state[table] if r[KEYS[table]] != values[KEYS[table]]] + [values]

    def published(self, state: dict, name: str) -> dict | None:
        pointer = self.row(state, "published", name)
        return self.row(state, "capture", pointer["capture_id"]) if pointer else None

    # Read ---------------------------------------------------------------------------------------------------------------------------

    def tables(self) -> Tables:
        """One version of everything, for the read surfaces; notices are those of complete captures."""
        state = self.state()

        def small(table: str) -> DataFrame:
            names = [c.split()[0] for c in SCHEMAS[table].split(", ")]
            rows = [tuple(dt.datetime.fromisoformat(v) if (v := r.get(c)) and c in TIMES else v for c in names) for r in state[table]]
            return self.spark.createDataFrame(rows, SCHEMAS[table])

        notice = self._rows([c for c in state["capture"] if c["status"] in ("published", "superseded")])
        exploded = notice.select("capture_id", "publication_year", "publication_number", F.inline("change_references"))
        return Tables(small("capture"), notice.drop("change_references"), exploded, small("published"), small("attempt"), small("run"), small("checkpoint"))

    def visible(self) -> DataFrame | None:
        """Rows of the published captures."""
        ids = [p["capture_id"] for p in self.state()["published"]]
        return self.tables().notice.where(F.col("capture_id").isin(ids)) if ids else None

    def violations(self) -> DataFrame:
        """Entries that break a constraint, by table."""
        t = self.tables()
        found = {"capture": capture_violations(t.capture.where("status <> 'failed'")), "attempt": attempt_violations(t.attempt), "run": run_violations(t.run)}
        parts = [v.select(F.lit(k).alias("table"), F.col(KEYS[k]).alias("id"), "violation") for k, v in found.items()]
        return parts[0].unionAll(parts[1]).unionAll(parts[2])

    # Captures -----------------------------------------------------------------------------------------------------------------------

    def _rows(self, captures: list[dict]) -> DataFrame:
        """Rows of the committed spans of some captures; files that no span names don't exist for a reader."""
        schema, paths = f"{FIELDS}, source_filename string, batch int, capture_id long", [os.path.join(self.root, x["folder"]) for c in captures for x in c["spans"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def load(self, name: str, sha: str, rows: Callable[[], DataFrame] | str, contract: str = CONTRACT, force: bool = False) -> int:
        """Publishes a capture of a package and returns its id. ``rows`` gives the rows, or is the archive's path. The same artifact under
        the same contract again is no work. An unfinished capture of it is resumed under its number and with its batch size: spans of batches
        that are committed stay, what isn't is written again. A bad member, an identity twice, an archive that changes meanwhile or a count
        that doesn't reconcile fails the capture, a lost machine leaves it unfinished; both leave what is visible as it was."""
        with self.change() as state:
            old = self.published(state, name)
            if old and not force and (old["artifact_sha256"], old["contract_version"]) == (sha, contract):
                return old["capture_id"]
            same = [c["capture_id"] for c in state["capture"] if c["status"] == "loading" and (c["source_package_id"], c["artifact_sha256"], c["contract_version"]) == (name, sha, contract)]
            new = max(same) if same and not force else self.add(state, "capture", source_package_id=name, artifact_sha256=sha, contract_version=contract, artifact_bytes=os.path.getsize(rows) if isinstance(rows, str) else None, status="loading", coverage_verified=False, acquired_at=_now(), batch_size=BATCH, spans=[], acquisition_ordinal=max((c["acquisition_ordinal"] for c in state["capture"]), default=0) + 1)
            row = self.row(state, "capture", new)
            #: What an earlier try has left behind, or still writes, is in another folder.
            row["tries"] = tries = row.get("tries", 0) + 1
        try:
            before = _digest(rows) if isinstance(rows, str) else None
            self._spans(new, tries, rows, name)
            if before is not None and _digest(rows) != before:
                raise BadArchive(f"{name}: the archive changed while it was read")
            counts = self._reconciled(new, name)
        except Exception as e:
            with self.change() as state:
                self.row(state, "capture", new).update(failure_reason=str(e)[:REASON], **({} if passing(e) else {"status": "failed"}))
            raise
        with self.change() as state:
            row = self._own(state, new, tries)
            if (old := self.published(state, name)) is not None:
                old["status"] = "superseded"
            row.update(status="published", published_at=_now(), **counts)
            self.put(state, "published", source_package_id=name, capture_id=new)
        return new

    def _own(self, state: dict, capture_id: int, tries: int) -> dict:
        row = self.row(state, "capture", capture_id)
        if row["status"] != "loading" or row["tries"] != tries:
            raise Refused(f"capture {capture_id} went on elsewhere")
        return row

    def _spans(self, capture_id: int, tries: int, rows: Callable[[], DataFrame] | str, name: str) -> None:
        """Writes the spans that aren't committed, one job each, and commits every one as it is done."""
        while True:
            row = self.row(self.state(), "capture", capture_id)
            if row["spans"] and row["spans"][-1]["ends"]:
                return
            first = row["spans"][-1]["last"] + 1 if row["spans"] else 0
            last, folder = first + SPAN - 1, f"capture_id={capture_id}/try={tries}/first={first}"
            if isinstance(rows, str):
                source = read_archives(self.spark, [rows], limits=package(name).ceilings, batch_size=row["batch_size"], first_batch=first, last_batch=last)
            else:
                source = rows()
                source = source if "batch" in source.columns else source.withColumn("batch", F.lit(0))
            seen = Observation()
            #: What was read, counted apart from what is in the files afterwards.
            source = source.observe(seen, F.count("*").alias("members"), F.coalesce(F.sum(F.size("change_references")), F.lit(0)).cast("long").alias("references"))
            source.drop(*NOT_OF_A_NOTICE).withColumn("capture_id", F.lit(capture_id).cast("long")).write.mode("overwrite").parquet(os.path.join(self.root, folder))
            ends = not isinstance(rows, str) or seen.get["members"] < SPAN * row["batch_size"]
            with self.change() as state:
                self._own(state, capture_id, tries)["spans"].append({"first": first, "last": last, "folder": folder, "ends": ends} | seen.get)

    def _reconciled(self, capture_id: int, name: str) -> dict:
        """The counts of a capture, if members read, distinct notices and rows in the files agree, and references read and in the files."""
        row = self.row(self.state(), "capture", capture_id)
        kept = self._rows([row])
        members, references = (sum(x[k] for x in row["spans"]) for k in ("members", "references"))
        loaded, stored, unnamed = kept.agg(F.count("*"), F.coalesce(F.sum(F.size("change_references")), F.lit(0)), F.count_if(F.col("publication_number").isNull() | F.col("publication_year").isNull())).first()
        distinct = kept.select("publication_year", "publication_number").distinct().count()
        spans = self.spark.createDataFrame([(x["first"], x["last"]) for x in row["spans"]], "first int, last int")
        batches = spans.select(F.explode(F.sequence("first", "last")).alias("batch"))
        if loaded == 0 or unnamed or not loaded == distinct == members or stored != references or not uncommitted(kept, batches, "batch").isEmpty():
            raise Refused(f"{name}: the capture doesn't reconcile: {members} members, {distinct} distinct, {loaded} rows; {references} references, {stored} stored")
        return {"member_count": members, "distinct_notice_count": distinct, "loaded_row_count": loaded}

    # Verification -------------------------------------------------------------------------------------------------------------------

    def verify(self, capture_id: int, listed: Callable[[Package], Listing]) -> dict:
        """One attempt to hold a published capture against the publisher's list; returns it as recorded. While it is open, and unless it
        ends as verified, the capture's coverage isn't."""
        state = self.state()
        capture = self.row(state, "capture", capture_id)
        if capture is None or self.published(state, capture["source_package_id"]) != capture:
            raise Refused(f"capture {capture_id} is not published")
        p = package(capture["source_package_id"])
        local = self._rows([capture])
        with self.change() as state:
            attempt_id = self.add(state, "attempt", capture_id=capture_id, artifact_sha256=capture["artifact_sha256"], contract_version=capture["contract_version"], verifier_version=VERSION, query_text=p.search, query_scope="ALL", state="in_progress", started_at=_now(), local_distinct_count=capture["distinct_notice_count"])
            self.row(state, "capture", capture_id)["coverage_verified"] = False
        found = self._compare(local, p, listed)
        with self.change() as state:
            row = self.row(state, "attempt", attempt_id)
            row.update(found, finished_at=_now())
            self.row(state, "capture", capture_id)["coverage_verified"] = row["state"] == "verified"
        return row

    def _compare(self, local: DataFrame, p: Package, listed: Callable[[Package], Listing]) -> dict:
        strangers = local.where(~p.holds(F.col("publication_date"))).count()
        if strangers:
            return {"state": "unavailable", "reason": f"{strangers} notices of the capture are outside {p.days[0]}..{p.days[1]}; the publisher was not asked"}
        try:
            seen, why = listed(p), None
        except Unavailable as e:
            seen, why = e.seen, str(e)[:REASON]
        except Exception as e:
            seen, why = None, f"{type(e).__name__}: {e}"[:REASON]
        out = {} if seen is None else {"announced_total": seen.total, "api_record_count": seen.records, "api_distinct_count": len(seen.keys), "api_duplicate_count": seen.repeated, "pages_fetched": seen.pages, "http_attempts": seen.calls}
        if why is not None:
            return out | {"state": "unavailable", "reason": why}
        theirs = self.spark.createDataFrame(sorted(seen.keys), "publication_year int, publication_number long").withColumn("_api", F.lit(True))
        side = F.when(F.col("_api").isNull(), "local").when(F.col("_local").isNull(), "api")
        both = local.select("publication_year", "publication_number", F.lit(True).alias("_local")).join(theirs, ["publication_year", "publication_number"], "full").withColumn("side", side).where("side is not null")
        counts = {r.side: r["count"] for r in both.groupBy("side").count().collect()}
        for k in ("local", "api"):
            out[f"only_{k}_count"] = counts.get(k, 0)
            some = both.where(F.col("side") == k).orderBy("publication_year", "publication_number").limit(SHOWN).collect() if k in counts else []
            out[f"only_{k}_sample"] = [f"{r.publication_number}-{r.publication_year}" for r in some]
        out["api_keys_sha256"], out["key_digest_recipe"] = seen.digest(), RECIPE
        if counts:
            return out | {"state": "mismatch", "reason": f"{out['only_local_count']} only in the capture, {out['only_api_count']} only at the publisher"}
        if seen.total == 0:
            return out | {"state": "empty_unconfirmed", "reason": "both are empty, which doesn't show that the package was published"}
        return out | {"state": "verified", "reason": None}

    # Runs ---------------------------------------------------------------------------------------------------------------------------

    def open_run(self, name: str) -> tuple[int, bool]:
        """The package's unfinished run and True, or a new one and False."""
        with self.change() as state:
            going = [r["run_id"] for r in state["run"] if r["source_package_id"] == name and r["phase"] in OPEN]
            if going:
                return max(going), True
            nth = max((r["attempt_ordinal"] for r in state["run"] if r["source_package_id"] == name), default=0) + 1
            return self.add(state, "run", source_package_id=name, attempt_ordinal=nth, phase="starting", started_at=_now(), updated_at=_now()), False

    def advance(self, run_id: int, /, **values: object) -> None:
        with self.change() as state:
            row = self.row(state, "run", run_id)
            if row["phase"] not in OPEN:
                raise Refused(f"run {run_id} is over")
            row.update(values, updated_at=_now())

    def seal(self, run_id: int) -> dict:
        """The checkpoint of a verified run; every condition is looked at again in the step that writes it, and what is unknown holds for
        none."""
        with self.change() as state:
            run = self.row(state, "run", run_id)
            c, name = self.row(state, "capture", run["capture_id"]), run["source_package_id"]
            tries = [a for a in state["attempt"] if a["capture_id"] == run["capture_id"]]
            a = max(tries, key=lambda x: x["attempt_id"], default=None)
            holds = run["phase"] == "source_verified" and c is not None and a is not None and c == self.published(state, name) and c["status"] == "published" and c["coverage_verified"] and a["state"] == "verified" and a["attempt_id"] == run["verification_attempt_id"]
            holds = holds and all(c.get(k) is not None and c.get(k) == x.get(k) for k in ("artifact_sha256", "contract_version") for x in (a,)) and run["artifact_sha256"] == c["artifact_sha256"]
            if not holds or not c["member_count"] == c["distinct_notice_count"] == c["loaded_row_count"]:
                raise Refused(f"{name}: the conditions of a checkpoint don't hold")
            self.put(state, "checkpoint", source_package_id=name, run_id=run_id, capture_id=c["capture_id"], verification_attempt_id=a["attempt_id"], artifact_sha256=c["artifact_sha256"], contract_version=c["contract_version"], notice_count=c["distinct_notice_count"], sealed_at=_now())
            run.update(phase="completed", completed_at=_now(), updated_at=_now(), last_error=None)
            return self.row(state, "checkpoint", name)
