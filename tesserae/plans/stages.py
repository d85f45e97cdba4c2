"""Stage order, completeness and resume by parameter digest."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from enum import StrEnum

from pyspark.sql import DataFrame, SparkSession


class Stage(StrEnum):
    AMBIENT = "ambient"
    HARMONIZE = "harmonize"
    DOUBLETS = "doublets"
    QC = "qc"
    ANNOTATE = "annotate"
    INTEGRATE = "integrate"
    PROJECT = "project"


def stages_between(first: str, last: str, project: bool = False) -> tuple[Stage, ...]:
    """Stages from first to last in order; projection only if asked for or named as the last."""
    order = list(Stage)
    a, b = order.index(Stage(first)), order.index(Stage(last))
    if a > b:
        raise ValueError(f"{first} comes after {last}")
    return tuple(s for s in order[a : b + 1] if s is not Stage.PROJECT or project or last == Stage.PROJECT)


def digest(params: dict) -> str:
    return hashlib.sha256(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()


@dataclass
class Run:
    """Runs units, each a (stage, unit) with parameters and a function that returns its table.

    A unit's table is Parquet below ``root``; beside it the digest of its parameters and of the units that it was made from, so
    that a unit made anew with other parameters makes all later ones stale. A unit whose digest is there is read
    back, unless ``force``. A unit that fails is recorded, and the others of its stage run on; one made from it is blocked.
    """

    spark: SparkSession
    root: str
    force: bool = False
    dry_run: bool = False
    status: list[tuple[str, str, str, str | None]] = field(default_factory=list)
    digests: dict[tuple[str, str], str] = field(default_factory=dict)

    def path(self, stage: str, unit: str) -> str:
        return f"{self.root.rstrip('/')}/{stage}/unit={unit}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def digest_of(self, stage: str, unit: str, params: dict, after: Sequence[tuple[str, str]] = ()) -> str:
        """Digest of a unit's parameters and of the digests of the units before it."""
        return digest({"params": params, "after": [(*u, self.digests.get(u)) for u in sorted(after)]})

    def complete(self, stage: str, unit: str, params: dict, after: Sequence[tuple[str, str]] = ()) -> bool:
        fs, done = self._fs(f"{self.path(stage, unit)}/_SUCCESS")
        fs2, mark = self._fs(f"{self.path(stage, unit)}.{self.digest_of(stage, unit, params, after)}")
        return fs.exists(done) and fs2.exists(mark)

    def unit(self, stage: str, unit: str, params: dict, make: Callable[[], DataFrame], after: Sequence[tuple[str, str]] = ()) -> DataFrame | None:
        path, key = self.path(stage, unit), (stage, unit)
        failed = {s[:2] for s in self.status if s[2] in ("failed", "blocked")}
        if blocked := [u for u in after if u in failed]:
            self.status.append((stage, unit, "blocked", f"waits for {blocked}"))
            return None
        mine = self.digest_of(stage, unit, params, after)
        stale = {s[:2] for s in self.status if s[2] in ("done", "planned")}
        if not self.force and self.complete(stage, unit, params, after) and not stale.intersection(after):
            self.digests[key] = mine
            self.status.append((stage, unit, "skipped", None))
            return self.spark.read.parquet(path)
        if self.dry_run:
            self.digests[key] = mine
            self.status.append((stage, unit, "planned", None))
            return None
        try:
            make().write.mode("overwrite").parquet(path)
        except Exception as e:  # a unit's failure is its own; callers see it in the status
            self.status.append((stage, unit, "failed", f"{type(e).__name__}: {str(e)[:300]}"))
            return None
        self._forget(stage, unit)
        fs, mark = self._fs(f"{path}.{mine}")
        fs.create(mark, True).close()
        self.digests[key] = mine
        self.status.append((stage, unit, "done", None))
        return self.spark.read.parquet(path)

    def _forget(self, stage: str, unit: str) -> None:
        """Delete the marks of earlier parameters."""
        fs, where = self._fs(f"{self.path(stage, unit)}.*")
        for f in fs.globStatus(where) or []:
            fs.delete(f.getPath(), True)

    def stages(self, plan: dict[str, Callable[[Run], None]]) -> bool:
        """Run stages in order, and stop after the first in which a unit fails or is blocked."""
        for stage, go in plan.items():
            try:
                go(self)
            except Exception as e:  # a stage's own failure ends the run as a unit's does
                self.status.append((stage, "*", "failed", f"{type(e).__name__}: {str(e)[:300]}"))
            if any(s[0] == stage and s[2] in ("failed", "blocked") for s in self.status):
                return False
        return True

    def remove(self, stage: str, keep: Sequence[str] = ()) -> list[str]:
        """Delete a stage's tables and marks, but for those of the units to keep; the names of the deleted units. The outputs of
        a stage go only if no unit of this run failed, since a next run may need them."""
        if self.exit_code or self.dry_run:
            return []
        fs, where = self._fs(f"{self.root.rstrip('/')}/{stage}/unit=*")
        gone = set()
        for f in fs.globStatus(where) or []:
            name = f.getPath().getName().removeprefix("unit=")
            owner = re.sub(r"\.[0-9a-f]{64}$", "", name)
            if owner not in keep:
                fs.delete(f.getPath(), True)
                gone.add(owner)
        return sorted(gone)

    def report(self) -> DataFrame:
        return self.spark.createDataFrame(self.status, "stage string, unit string, state string, error string")

    @property
    def exit_code(self) -> int:
        return int(any(s[2] in ("failed", "blocked") for s in self.status))


def needs_label_refresh(prepared: list[str] | None, annotated: bool, label: str = "Level_3") -> bool:
    """Whether prepared cells must be made again since labels came after them: they exist (``prepared``: the annotation columns
    that they recorded, None if they do not exist), annotated cells exist, and the label is not among the columns."""
    return annotated and prepared is not None and label not in prepared


def validate(config: dict, planned: Sequence[Stage], exists: Callable[[str], bool]) -> None:
    """Raise for inputs that the planned stages need and the configuration lacks (all at once), or that do not exist."""
    # fixed values: the inputs of every run, and those of the projection
    always = {"sample_info_csv": "file", "gtf_file": "file", "output_root": ""}
    project = {"projection_atlas_h5ad": "file", "projection_model_dir": "folder"}
    needed = always | (project if Stage.PROJECT in planned else {})
    if missing := [k for k in needed if not str(config.get(k) or "").strip()]:
        raise ValueError("missing inputs: " + ", ".join(missing))
    for key, kind in needed.items():
        if kind and not exists(str(config[key])):
            raise FileNotFoundError(f"{key}: no such {kind}: {config[key]}")
