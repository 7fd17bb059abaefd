"""Sample metadata and cell-type annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliograph.functions import names
from heliograph.operators.guards import ContractError, one_to_one, require_columns, require_none, require_unique

NOT_AVAILABLE = "notAvailable"
#: Sheet column -> name here. Fixed values.
COLUMNS = {
    "PROJID": "project_id", "SAMID": "sample_id", "sample_name": "sample_name", "organism": "biosource_organism", "tissueOntologyName": "biosource_tissue", "tissueOntologyID": "biosource_tissue_ontology_id",
    "isCellLine": "biosource_is_cell_line", "isOrganoid": "biosource_is_organoid", "cellLineOntologyName": "biosource_cell_line", "cellLineOntologyID": "biosource_cell_line_ontology_id", "cellOntologyName": "biosource_cell_type",
    "cellOntologyID": "biosource_cell_type_ontology_id", "diseaseOntologyName": "biosource_disease", "diseaseOntologyID": "biosource_disease_ontology_id", "treatment": "experiment_treatment", "genotype": "experiment_genotype",
    "group": "experiment_group", "donor": "donor_id", "sex": "donor_sex", "age": "donor_age", "age_group": "donor_age_group",
}
#: Fields by which context means are taken. Fixed values.
CONTEXT_FIELDS = ["sample_name", "biosource_cell_line", "biosource_cell_type", "gpt_cell_type", "biosource_disease", "experiment_treatment", "experiment_genotype", "experiment_group", "donor_id", "donor_sex", "donor_age", "donor_age_group"]
#: The confidence levels of an annotation. Fixed values.
CONFIDENCE = ("high", "medium", "low")
ANNOTATIONS = T.StructType([T.StructField("annotations", T.ArrayType(T.StructType([T.StructField(n, T.BooleanType() if n == "tissue_consistent" else T.StringType()) for n in ("old_cluster", "cell_type", "cell_ontology_id", "confidence", "tissue_consistent", "reason")])))])


def dataset_metadata(sheet: DataFrame, dataset: str, files: DataFrame | None = None) -> DataFrame:
    """The dataset's samples under their names here, blanks filled, with sample_file if a file map is given."""
    require_columns(sheet, "gse", *COLUMNS)
    d = F.lit(dataset)
    rows = sheet.filter(F.trim("gse") == names.accession(d))
    ending = next((o for e, o in names.ORGANISMS if dataset.endswith(e)), None)
    if ending:
        rows = rows.filter(F.trim("organism") == ending)
    if not rows.take(1):
        raise ContractError(f"no sample of {dataset}")
    if files is not None:
        require_columns(files, "gse", "SAMID", "sample_file")
        rows = one_to_one(rows, files.select("gse", "SAMID", "sample_file"), ["gse", "SAMID"], "samples without a file")
    require_unique(rows, "sample_name")
    if rows.select("organism").distinct().count() != 1:
        raise ContractError("more than one organism")
    trimmed = [F.coalesce(F.trim(old), F.lit(NOT_AVAILABLE)).alias(new) for old, new in COLUMNS.items()]
    return rows.select(*trimmed, *(["sample_file"] if files is not None else []))


def join_metadata(cells: DataFrame, meta: DataFrame) -> DataFrame:
    """cells (with sample_name) with their sample's columns; both must name the same samples."""
    a, b = cells.select("sample_name").distinct(), meta.select("sample_name")
    require_none(a.join(b, "sample_name", "left_anti"), "samples without metadata")
    require_none(b.join(a, "sample_name", "left_anti"), "samples without cells")
    return cells.join(meta, "sample_name", "left")


def resolve_input(samples: DataFrame, paths: DataFrame) -> DataFrame:
    """sample_name, path, rule: by sample name, then by file name; exact before a substring, which must be the only one."""
    p = paths.select(F.col("path")).distinct()
    out = samples.select("sample_name", "sample_file").distinct()
    for i, key in enumerate(("sample_name", "sample_file")):
        exact = samples.select(F.col(key).alias("_k")).distinct().join(p, F.col("_k") == F.col("path")).select(F.col("_k").alias(key), F.col("path").alias(f"_e{i}"))
        out = out.join(exact, key, "left")
        # directory listings are short: a few entries a sample
        part = samples.select(F.col(key).alias("_k")).distinct().join(F.broadcast(p), F.contains(F.col("path"), F.col("_k"))).groupBy("_k").agg(F.count("*").alias("_n"), F.min("path").alias("_p"))
        out = out.join(part.filter("_n = 1").select(F.col("_k").alias(key), F.col("_p").alias(f"_s{i}")), key, "left")
    order = ["_e0", "_s0", "_e1", "_s1"]
    rule = F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(n)) for c, n in zip(order, ("name", "name_part", "file", "file_part"))])
    return out.select("sample_name", F.coalesce(*order).alias("path"), rule.alias("rule"))


def parse_annotations(responses: DataFrame, column: str = "json") -> DataFrame:
    return responses.select(F.explode(F.from_json(column, ANNOTATIONS)["annotations"]).alias("a")).select("a.*")


def annotation_faults(annotations: DataFrame, clusters: DataFrame) -> DataFrame:
    """old_cluster, fault: what breaks the contract. clusters: old_cluster."""
    a, c = annotations, clusters.select("old_cluster").distinct()
    fault = F.when(~F.coalesce(F.col("cell_ontology_id").rlike(r"^CL:\d{7}$"), F.lit(False)), "ontology id").when(~F.coalesce(F.col("confidence").isin(*CONFIDENCE), F.lit(False)), "confidence").when(F.col("tissue_consistent").isNull(), "tissue_consistent").when(F.trim(F.coalesce("cell_type", F.lit(""))) == "", "cell type")
    bad = a.withColumn("fault", fault).filter("fault is not null").select("old_cluster", "fault")
    missing = c.join(a, "old_cluster", "left_anti").select("old_cluster", F.lit("missing").alias("fault"))
    odd = a.join(c, "old_cluster", "left_anti").select("old_cluster", F.lit("unexpected").alias("fault"))
    twice = a.groupBy("old_cluster").count().filter("count > 1").select("old_cluster", F.lit("repeated").alias("fault"))
    return bad.unionByName(missing).unionByName(odd).unionByName(twice)


def label_cells(cells: DataFrame, annotations: DataFrame) -> DataFrame:
    """cells (with old_cluster) with gpt_cell_type and its ontology id; every cluster must have its valid annotation."""
    require_none(annotation_faults(annotations, cells.select("old_cluster")), "annotation")
    return cells.join(annotations.select("old_cluster", F.col("cell_type").alias("gpt_cell_type"), F.col("cell_ontology_id").alias("gpt_cell_ontology_id")), "old_cluster", "left")


def annotate_with_retries(cells: DataFrame, ask, attempts: int = 3) -> DataFrame:
    """ask(attempt) -> annotations; asked again while the answer breaks the contract."""
    for i in range(attempts):
        try:
            return label_cells(cells, ask(i))
        except ContractError:
            if i + 1 == attempts:
                raise
    raise ContractError("no attempt")


def marker_payload(markers: DataFrame, samples: DataFrame, dataset: str, k: int = 50) -> DataFrame:
    """payload: JSON of dataset, sample_metadata and the top markers by cluster."""
    from heliograph.operators.cells import top_markers

    by = top_markers(markers, k).groupBy("group").agg(F.sort_array(F.collect_list(F.struct("rank", F.struct("names", "scores", "logfoldchanges", "pvals_adj").alias("m")))).alias("x"))
    clusters = by.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("group", F.transform("x", lambda s: s["m"]).alias("m"))))).alias("clusters"))
    meta = samples.agg(F.sort_array(F.collect_list(F.struct(*samples.columns))).alias("sample_metadata"))  # some rows a dataset
    return meta.crossJoin(clusters).select(F.to_json(F.struct(F.lit(dataset).alias("dataset"), "sample_metadata", "clusters"), {"ignoreNullFields": "false"}).alias("payload"))
