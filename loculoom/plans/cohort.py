"""The nine stages wired to storage: what each reads, writes and registers.  Tables are Parquet, reports leave as text.

A stage writes the output that marks it as done last, so a run that lost executors is repeated from its first open stage.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, ibd, reports, samples
from ..sources import binary, files, readers, writers
from . import stages
from .workflow import (
    NEEDS, PHASE1, PHASE2, REGISTERS, Runner, Stage, Thresholds, output_prefix, pipeline_table, reference_path, setting, spark_done, thresholds, validate_selection,
)


@dataclass(frozen=True)
class PlateInputs:
    """A plate: GTC files, Parquet of their sites(bpm_index, chrom, pos, ref, alt[, allele_a, allele_b]), the manifest that names the
    samples, and if there are any Parquet of sexes(sample_id, sex) or a registry that tells them, a VCF of reference frequencies, and
    the reference sequence: a FASTA file with its index (.fa, .fasta) or Parquet of (chrom, pos, base)."""

    gtc: str
    sites: str
    manifest: str
    sexes: str | None = None
    frequencies: str | None = None
    reference: str | None = None
    registry: str | None = None


@dataclass(frozen=True)
class MergeInputs:
    """A rolling merge: filesets of plates, Parquet of the wanted samples(sample_id), the array's cluster scores, and if there
    is one the carried aggregate with Parquet of its withdrawn samples(sample_id)."""

    plates: tuple[str, ...]
    wanted: str
    egt: str
    previous: str | None = None
    withdrawn: str | None = None
    baf: tuple[str, ...] = ()
    thresholds: Thresholds = field(default_factory=Thresholds)
    genome_length: int = 2_875_000_000
    x_length: int = 153_000_000
    min_samples: int = 50
    min_snps: int = 64
    min_bp: int = 2_500_000


def plate_stages(spark: SparkSession, given: PlateInputs, root: str, workflow: str, cohort: str | None = None) -> dict[str, Stage]:
    """Phase 1.  Outputs: <GtcToBcfs>/heavy, light and metadata, <BafRegress>/baf, <CohortBcfToPlink>/samples, calls,
    genotypes (a row a variant) and plink.bed, .bim and .fam."""
    at = {n: output_prefix(root, workflow, n) for n in PHASE1}

    def decode(context: dict) -> None:
        names = readers.manifest_reheader(readers.manifest_csv(spark, given.manifest))
        if given.registry and cohort:
            # every sample of the cohort must be in the manifest
            members = readers.registry(spark, given.registry)[0].filter(F.col("cohort_id") == cohort).select("sg_id").distinct()
            names = names if members.isEmpty() else catalog.gtc_mapping(names, members)
        writers.reheader(names, f"{at['GtcToBcfs']}/reheader", "overwrite")
        bases = given.reference
        if bases and not bases.endswith((".fa", ".fasta")):
            bases = spark.read.parquet(bases)
        heavy, _ = stages.plate_calls(binary.read_gtc(spark, given.gtc), spark.read.parquet(given.sites), names, bases)
        writers.gtc_metadata(binary.read_gtc_metadata(spark, given.gtc), f"{at['GtcToBcfs']}/metadata", "overwrite")
        writers.calls(heavy, f"{at['GtcToBcfs']}/heavy", "overwrite")
        # the light calls are columns of the heavy ones: the files are decoded once
        light = spark.read.parquet(f"{at['GtcToBcfs']}/heavy").select("chrom", "pos", "ref", "alt", "variant_id", "sample_id", "dosage", "gq", "bpm_index")
        writers.calls(light, f"{at['GtcToBcfs']}/light", "overwrite")

    def contamination(context: dict) -> None:
        af = readers.af_reference(spark, given.frequencies) if given.frequencies else None
        stages.contamination(spark.read.parquet(f"{at['GtcToBcfs']}/heavy"), af).write.mode("overwrite").parquet(f"{at['BafRegress']}/baf")

    def fileset(context: dict) -> None:
        light = spark.read.parquet(f"{at['GtcToBcfs']}/light")
        people = light.select("sample_id").distinct()
        sexes = spark.createDataFrame([], "sample_id string, sex int")
        if given.sexes or given.registry:
            sexes = spark.read.parquet(given.sexes) if given.sexes else readers.registry_sexes(spark, given.registry)
        writers.id_pairs(sexes.join(people, "sample_id", "left_semi"), f"{at['CohortBcfToPlink']}/sexes", "sex", mode="overwrite")
        samples.update_sex(people, sexes).write.mode("overwrite").parquet(f"{at['CohortBcfToPlink']}/samples")
        clean = stages.plate_fileset(light)
        people = files.samples_in_order(spark.read.parquet(f"{at['CohortBcfToPlink']}/samples"))
        files.write_plink1(packed(clean, people, f"{at['CohortBcfToPlink']}/genotypes"), people, f"{at['CohortBcfToPlink']}/plink", "overwrite")
        writers.calls(clean, f"{at['CohortBcfToPlink']}/calls", "overwrite")

    return named({"GtcToBcfs": (decode, f"{at['GtcToBcfs']}/light"), "BafRegress": (contamination, f"{at['BafRegress']}/baf"), "CohortBcfToPlink": (fileset, f"{at['CohortBcfToPlink']}/calls")})


def merge_stages(spark: SparkSession, given: MergeInputs, root: str, workflow: str, version: str, temporary: str | None = None) -> dict[str, Stage]:
    """Phase 2.  A fileset (of a plate, or the aggregate) is a folder with samples and calls; the merge and the export's BCF are temporary outputs."""
    at = {n: output_prefix(root, workflow, n, version) for n in PHASE2}
    at["MergeCohortPlink"] = output_prefix(temporary or root, workflow, "MergeCohortPlink", version)
    bcf = f"{output_prefix(temporary or root, workflow, 'ExportCohortDatasets', version)}/cohort.bcf"
    read = spark.read.parquet

    def merge(context: dict) -> None:
        wanted, gone = read(given.wanted), read(given.withdrawn) if given.withdrawn else None
        writers.id_pairs(wanted, f"{at['MergeCohortPlink']}/keep", mode="overwrite")
        if gone is not None:
            writers.id_pairs(gone, f"{at['MergeCohortPlink']}/remove", mode="overwrite")
        previous = read(f"{given.previous}/calls") if given.previous else None
        calls = samples.rolling_merge(previous, gone, [read(f"{p}/calls") for p in given.plates], wanted)
        people = None
        for p in ([given.previous] if given.previous else []) + list(given.plates):
            people = read(f"{p}/samples") if people is None else people.unionByName(read(f"{p}/samples"))
        people.join(wanted.select("sample_id").distinct(), "sample_id", "left_semi").write.mode("overwrite").parquet(f"{at['MergeCohortPlink']}/samples")
        writers.calls(calls, f"{at['MergeCohortPlink']}/calls", "overwrite")

    def merged(kind: str, name: str = "MergeCohortPlink") -> DataFrame:
        return read(f"{at[name]}/{kind}")

    def export(context: dict) -> None:
        to = at["ExportCohortDatasets"]
        merged("samples").write.mode("overwrite").parquet(f"{to}/samples")
        people = files.samples_in_order(merged("samples"))
        # PGEN stays, BCF is for the tools of the run; REF comes first in both, and both are written in one pass
        files.write_files(packed(merged("calls"), people, f"{to}/genotypes"), people, {"pgen": f"{to}/cohort.pgen", "pvar": f"{to}/cohort.pvar", "bcf": bcf}, "overwrite")
        files.write_psam(people, f"{to}/cohort.psam")
        writers.calls(merged("calls"), f"{at['ExportCohortDatasets']}/calls", "overwrite")

    def raw_qc(context: dict) -> None:
        tables = stages.raw_qc(merged("calls", "ExportCohortDatasets"), merged("samples", "ExportCohortDatasets"), given.min_samples)
        for name in ("afreq", "smiss", "het", "sexcheck"):
            tables[name].write.mode("overwrite").parquet(f"{at['Plink2Qc']}/{name}")

    def related(context: dict) -> None:
        # the segments are compared once; both summaries are read off the written ones
        to, calls = at["KingIbdseg"], stages.recoded(merged("calls"))
        ibd.segments_x(calls, given.min_snps, given.min_bp).write.mode("overwrite").parquet(f"{to}/segments_x")
        ibd.sharing_with_sex(read(f"{to}/segments_x"), merged("samples"), given.x_length).write.mode("overwrite").parquet(f"{to}/seg_x")
        writers.segments(read(f"{to}/seg_x"), f"{to}/seg_x_tsv", writers.SEG_X_HEADER, "overwrite")
        stages.autosomal_segments(calls, given.min_snps, given.min_bp).write.mode("overwrite").parquet(f"{to}/segments")
        pairs = ibd.relatives(ibd.sharing(read(f"{to}/segments"), given.genome_length)).withColumnsRenamed({"s1": "ID1", "s2": "ID2"})
        writers.segments(pairs, f"{to}/seg_tsv", mode="overwrite")
        for name in ("segments", "segments_x"):
            writers.segment_rows(read(f"{to}/{name}"), f"{to}/{name}_tsv", "overwrite")
        pairs.write.mode("overwrite").parquet(f"{to}/seg")

    def variant_report(context: dict) -> None:
        flagged = stages.snp_qc(merged("calls", "ExportCohortDatasets"), merged("samples", "ExportCohortDatasets"), readers.cluster_scores(spark, given.egt), given.thresholds)
        flagged.write.mode("overwrite").parquet(f"{at['SnpQcReport']}/flags")
        flagged = read(f"{at['SnpQcReport']}/flags")
        writers.variant_qc(flagged, *[f"{at['SnpQcReport']}/{x}" for x in ("audit", "inclusion", "summary")], mode="overwrite")

    def sample_report(context: dict) -> None:
        smiss, het, sexcheck = (reports.tool_names(read(f"{at['Plink2Qc']}/{n}")) for n in ("smiss", "het", "sexcheck"))
        seg = read(f"{at['KingIbdseg']}/seg").withColumn("ord", F.concat_ws(":", "ID1", "ID2"))
        baf = None
        for p in given.baf:
            one = read(p).withColumnRenamed("sample_id", "IID")
            baf = one if baf is None else baf.unionByName(one)
        writers.sample_qc(reports.sample_qc(smiss, het, sexcheck, reports.relatedness_wide(seg), baf), f"{at['QcReport']}/report", mode="overwrite")

    return named({
        "MergeCohortPlink": (merge, f"{at['MergeCohortPlink']}/calls"), "ExportCohortDatasets": (export, f"{at['ExportCohortDatasets']}/calls"), "Plink2Qc": (raw_qc, f"{at['Plink2Qc']}/sexcheck"),
        "KingIbdseg": (related, f"{at['KingIbdseg']}/seg"), "SnpQcReport": (variant_report, f"{at['SnpQcReport']}/summary"), "QcReport": (sample_report, f"{at['QcReport']}/report"),
    })


def packed(calls: DataFrame, people: DataFrame, path: str) -> DataFrame:
    """``genotype_rows``, written: computed once, whichever files are made of them."""
    files.genotype_rows(calls, people).write.mode("overwrite").parquet(path)
    return calls.sparkSession.read.parquet(path)


def named(found: dict) -> dict[str, Stage]:
    return {n: Stage(n, run, output, NEEDS[n], REGISTERS.get(n)) for n, (run, output) in found.items()}


def run(spark: SparkSession, given: PlateInputs | MergeInputs, cohort: str, only: list[str], root: str, workflow: str, registry: str | None = None, dry_run: bool = False, temporary: str | None = None) -> list[str]:
    """Run the selected stages of a cohort and return the log.  Finished outputs are reused; analyses are registered once
    their outputs are there.  Phase 2 keeps its outputs by cohort, phase 1 by workflow."""
    phase = validate_selection(only, [cohort])
    if isinstance(given, PlateInputs) != (phase == 1):
        raise ValueError(f"inputs of the other phase than {phase}")
    found = plate_stages(spark, given, root, workflow, cohort) if phase == 1 else merge_stages(spark, given, root, workflow, cohort, temporary)

    def register(kind: str, path: str) -> None:
        if registry:
            writers.register(spark, cohort, kind, path, registry)

    def registered(path: str) -> bool:
        return not registry or writers.registered(spark, registry, path)

    return Runner(found, done=spark_done(spark), register=register, registered=registered).run({}, only, dry_run)


#: Keys of the [inputs] table that are not lists, by phase; those of phase 2 that are.
PLATE_KEYS, MERGE_KEYS, MERGE_LISTS = ("gtc", "sites", "manifest", "sexes", "frequencies", "reference", "registry"), ("wanted", "egt", "previous", "withdrawn"), ("plates", "baf")
MERGE_NUMBERS = ("genome_length", "x_length", "min_samples", "min_snps", "min_bp")


def configured(config: dict, cohort: str, phase: int) -> PlateInputs | MergeInputs:
    """The inputs of a cohort by a configuration: [inputs] for every cohort, [inputs.<cohort>] before it; ``{cohort}`` in a path is its id.

    References are given by key ([<pipeline>.references] for plates, egt_info_reference_key for a merge); thresholds come from
    [<pipeline>.snp_qc_report.thresholds], whatever the pipeline's table is called."""
    table = setting(config, "inputs", default={})
    own = {k: v for k, v in table.items() if not isinstance(v, dict)} | table.get(cohort, {})
    allowed = PLATE_KEYS if phase == 1 else (*MERGE_KEYS, *MERGE_LISTS, *MERGE_NUMBERS)
    if unknown := sorted(set(own) - set(allowed)):
        raise ValueError(f"unknown inputs: {', '.join(unknown)}")
    filled = lambda v: v.replace("{cohort}", cohort) if isinstance(v, str) else tuple(map(filled, v)) if isinstance(v, list) else v
    own = {k: filled(v) for k, v in own.items()}
    if phase == 1:
        for key, name in (("fasta_ref_path", "reference"), ("af_ref_path", "frequencies")):
            if found := setting(pipeline_table(config), "references", key):
                own.setdefault(name, reference_path(config, found))
        own = own | {k: reference_path(config, own[k]) for k in ("reference", "frequencies") if own.get(k)}
        needed, make = ("gtc", "sites", "manifest"), PlateInputs
    else:
        own.setdefault("egt", setting(pipeline_table(config), "snp_qc_report", "egt_info_reference_key"))
        own = own | {"thresholds": thresholds(config)} | ({"egt": reference_path(config, own["egt"])} if own["egt"] else {})
        needed, make = ("plates", "wanted", "egt"), MergeInputs
    if missing := [k for k in needed if not own.get(k)]:
        raise ValueError(f"missing inputs: {', '.join(missing)}")
    return make(**own)


def run_configured(spark: SparkSession, config: dict, dry_run: bool = False) -> dict[str, list[str]]:
    """Run the stages that a configuration selects, cohort by cohort; the log of each."""
    only, cohorts = setting(config, "workflow", "only_stages", default=[]), setting(config, "workflow", "input_cohorts", default=[])
    phase = validate_selection(only, cohorts)
    if not cohorts:
        raise ValueError("input_cohorts is not set")
    root, name = setting(config, "workflow", "output_root"), setting(config, "workflow", "name", default="genotyping")
    if not root:
        raise ValueError("output_root is not set")
    registry, temporary = setting(config, "workflow", "registry"), setting(config, "workflow", "temporary_root")
    given = {c: configured(config, c, phase) for c in cohorts}  # all are read before the first runs
    where = {c: f"{name}/{c}" if phase == 1 else name for c in cohorts}
    return {c: run(spark, given[c], c, only, root, where[c], registry, dry_run, temporary) for c in cohorts}
