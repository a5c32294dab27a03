"""Stage graph: selection rules, configuration, skip of finished outputs, ordered runs, registration."""

from __future__ import annotations

import tomllib
from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

#: Stage names by phase, analysis types, what each stage registers, and what it needs within a run.
PHASE1 = ("GtcToBcfs", "BafRegress", "CohortBcfToPlink")
PHASE2 = ("MergeCohortPlink", "ExportCohortDatasets", "Plink2Qc", "KingIbdseg", "SnpQcReport", "QcReport")
ANALYSIS_TYPES = ("array_bafregress", "array_cohort_bed", "array_aggregate_pgen", "array_qc_raw", "array_relatedness_ibdseg", "array_snp_qc", "array_qc_report", "manifest")
REGISTERS = {
    "BafRegress": "array_bafregress", "CohortBcfToPlink": "array_cohort_bed", "ExportCohortDatasets": "array_aggregate_pgen", "Plink2Qc": "array_qc_raw",
    "KingIbdseg": "array_relatedness_ibdseg", "SnpQcReport": "array_snp_qc", "QcReport": "array_qc_report",
}
NEEDS = {
    "GtcToBcfs": (), "BafRegress": ("GtcToBcfs",), "CohortBcfToPlink": ("GtcToBcfs",), "MergeCohortPlink": (), "ExportCohortDatasets": ("MergeCohortPlink",),
    "KingIbdseg": ("MergeCohortPlink",), "Plink2Qc": ("ExportCohortDatasets",), "SnpQcReport": ("ExportCohortDatasets",), "QcReport": ("Plink2Qc", "KingIbdseg"),
}


@dataclass(frozen=True)
class Thresholds:
    """Defaults of the variant filters; production values come from the configuration file."""

    gentrain_min: float = 0.7
    cluster_sep_min: float = 0.4
    fmiss_max: float = 0.02
    hwe_p: float = 1e-5
    hwe_k: float = 0.001
    midp: bool = True
    keep_few_het: bool = True


def load_config(path: str) -> dict:
    with open(path, "rb") as f:
        return tomllib.load(f)


#: Tables of a configuration besides the one of the pipeline, which may have any name.
COMMON_TABLES = ("workflow", "inputs", "references")


def pipeline_table(config: dict) -> dict:
    """The pipeline's own table of a configuration: the only one that is not common; empty if there is none."""
    own = sorted(k for k, v in config.items() if isinstance(v, dict) and k not in COMMON_TABLES)
    if len(own) > 1:
        raise ValueError(f"several tables may be the pipeline's: {', '.join(own)}")
    return config[own[0]] if own else {}


#: Keys of the thresholds.
THRESHOLD_KEYS = {
    "gentrain_min": "gentrain_min", "cluster_sep_min": "cluster_sep_min", "fmiss_max": "fmiss_max", "hwe_p": "hwe_p", "hwe_k": "hwe_k", "hwe_midp": "midp", "hwe_keep_fewhet": "keep_few_het",
}


def thresholds(config: dict) -> Thresholds:
    """The variant filters of a configuration; a key that is not known is an error, so that a misspelt one is not passed over."""
    given = setting(pipeline_table(config), "snp_qc_report", "thresholds", default={})
    if unknown := sorted(set(given) - set(THRESHOLD_KEYS)):
        raise ValueError(f"unknown thresholds: {', '.join(unknown)}")
    wrong = [k for k, v in given.items() if isinstance(v, bool) != isinstance(getattr(Thresholds(), THRESHOLD_KEYS[k]), bool) or not isinstance(v, (int, float))]
    if wrong:
        raise ValueError(f"thresholds of the wrong type: {', '.join(sorted(wrong))}")
    return Thresholds(**{THRESHOLD_KEYS[k]: v for k, v in given.items()})


def reference_path(config: dict, key: str) -> str:
    """The path of a reference by its key, ``folder/name``, in the table [references] (or the key itself, if it is a path)."""
    if key.startswith("/") or "://" in key:
        return key
    found = setting(config, "references", *key.split("/"))
    if not isinstance(found, str):
        raise ValueError(f"no reference {key}")
    return found


def setting(config: dict, *keys: str, default=None):
    for k in keys:
        if not isinstance(config, dict) or k not in config:
            return default
        config = config[k]
    return config


def output_prefix(root: str, workflow: str, stage: str, version: str | None = None) -> str:
    return "/".join([root.rstrip("/"), workflow, stage, *([version] if version else [])])


def project_name(name: str, test: bool) -> str:
    return name if not test or name.endswith("-test") else f"{name}-test"


def validate_selection(only_stages: list[str] | None, cohorts: list[str]) -> int:
    """The phase (1 or 2) of a selection; names are case-sensitive, phases do not mix, phase 2 takes one cohort."""
    if not only_stages:
        raise ValueError("only_stages is not set")
    chosen = set(only_stages)
    if unknown := sorted(chosen - set(PHASE1) - set(PHASE2)):
        raise ValueError(f"unknown stages: {', '.join(unknown)}")
    if chosen & set(PHASE1) and chosen & set(PHASE2):
        raise ValueError("stages of both phases")
    phase = 1 if chosen & set(PHASE1) else 2
    if phase == 2 and len(cohorts) != 1:
        raise ValueError(f"phase 2 takes exactly one cohort, got {len(cohorts)}")
    return phase


@dataclass
class Stage:
    """``run(context)`` writes ``output``; it is skipped if ``done(output)``."""

    name: str
    run: Callable[[dict], None]
    output: str
    needs: tuple[str, ...] = ()
    registers: str | None = None


@dataclass
class Runner:
    stages: dict[str, Stage]
    done: Callable[[str], bool]
    register: Callable[[str, str], None] = lambda kind, path: None
    registered: Callable[[str], bool] = lambda path: True
    log: list[str] = field(default_factory=list)

    def order(self, only: list[str] | None = None) -> list[str]:
        names = TopologicalSorter({s.name: [n for n in s.needs if n in self.stages] for s in self.stages.values()}).static_order()
        return [n for n in names if only is None or n in only]

    def run(self, context: dict, only: list[str] | None = None, dry_run: bool = False) -> list[str]:
        """Run what is not done, in order; an analysis is registered only after its output is there.

        A run may end between the two, so a finished output that is not registered yet is registered when it is reused."""
        if unknown := sorted({s.registers for s in self.stages.values() if s.registers} - set(ANALYSIS_TYPES)):
            raise ValueError(f"unknown analysis types: {', '.join(unknown)}")
        for name in self.order(only):
            stage = self.stages[name]
            there = self.done(stage.output)
            if dry_run:
                self.log.append(f"{name}: {'reused' if there else 'would run'}")
                continue
            if not there:
                stage.run(context)
            late = there and stage.registers is not None and not self.registered(stage.output)
            if stage.registers and (late or not there):
                self.register(stage.registers, stage.output)
            self.log.append(f"{name}: {'reused, registered now' if late else 'reused' if there else 'done'}")
        return self.log


def spark_done(spark) -> Callable[[str], bool]:
    """Whether an output is committed, asked of the store that holds it."""

    def done(path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    return done
