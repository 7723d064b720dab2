"""HMIS extract cleaning and the wide enrollment table.

Each ``get_*`` job is S2 (read, stack, drop, dedup, recode, parse dates)
followed by the table's own step.  ``merge_tables`` joins them on
enrollment id (J3, J5), person id (J4, with the birth-date repair D8-D10)
and program id (J6).  Everything stays lazy; the counts the reference
prints are collected with ``DataFrame.observe`` when an action runs.
"""

from __future__ import annotations

import warnings
from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import recode as rc
from ..operators import aggregates as ag
from ..operators import dedup, joins, reshape
from ..session import materialize
from ..sources import hmis_config
from ..sources.readers import (ROW_ORD, SRC_ORD, drop_if_present, ordered, read_one, resolve_file_spec,
                               stack_by_name)
from ..sources.spec import get_metadata_dict

ORDER = [SRC_ORD, ROW_ORD]


def _meta(metadata) -> dict:
    """A configuration: a dict, or the path of a JSON file in any store that Spark reads."""
    if metadata is None:
        return {}
    if isinstance(metadata, str):
        return get_metadata_dict(metadata)
    d = dict(metadata)
    d.pop("name", None)
    return d


def read_table(spark: SparkSession, file_spec, county=None, data_dir=None, paths=None,
               columns_to_drop=None, categorical_var=None,
               categorical_unknown=codes.UNKNOWN_CODES, time_var=None,
               duplicate_check_columns=None, dedup_rows: bool = True, encoding=None,
               name_columns=None, key_columns=None, numeric_columns=None, fmt: str = "csv", multi_line: bool = False,
               compat_order: bool = False, keep_order: bool = False) -> DataFrame:
    """Scan + stack + BOM strip + drop + keep-last dedup + recode + dates.

    ``file_spec`` is a file name (with ``county`` or ``data_dir``/``paths``)
    or a dict ``{folder: path}``; a dict value may also be a DataFrame.
    Code columns become numbers where all their values are: the stacked text
    is written once to the checkpoint folder, which counts its non-numbers,
    and the columns are cast on reading that table, so the files are parsed
    once, however many steps follow.  ``numeric_columns`` become doubles, time columns
    timestamps; every other column keeps its text, that of ``key_columns``
    in one form ("1.0" is "1").  Dedup runs on these values, before recode
    and date parsing.  ``multi_line`` accepts line breaks inside quotes.
    """
    spec = resolve_file_spec(file_spec, county, data_dir, paths)
    items = list(spec.items())
    if compat_order and len(items) > 1:
        items = [items[-1]] + items[:-1]
    frames = []
    for i, (_, src) in enumerate(items):
        frames.append(ordered(src, i) if isinstance(src, DataFrame)
                      else read_one(spark, src, fmt, encoding, multi_line=multi_line, source=i))
    df = stack_by_name(frames)
    df = rc.null_tokens(df)
    df = drop_if_present(df, list(columns_to_drop or []))
    counts = rc.number_counts(df, list(categorical_var or []))
    if counts:
        seen = Observation("numbers")
        df, _ = materialize(df.observe(seen, *[n.alias(c) for c, n in counts.items()]), "landed")
        df = rc.typed_numbers(df, seen.get)
    text = {c for c, t in df.dtypes if t == "string"}
    df = df.withColumns({c: rc.whole_number_text(F.col(c)) for c in (key_columns or []) if c in text}
                        | {c: F.trim(F.col(c)).try_cast("double") for c in (numeric_columns or []) if c in text})
    if dedup_rows:
        if duplicate_check_columns is None:
            warnings.warn("dedup is True but duplicate_check_columns is None, no deduplication")
        else:
            df = dedup.keep_last(df, list(duplicate_check_columns), ORDER)
    types = dict(df.dtypes)
    cats = [c for c in (categorical_var or []) if c in types]
    if cats:
        df = rc.recode_unknown(df, cats, categorical_unknown)
    tv = [c for c in (time_var or []) if c in types]
    if tv:
        df = rc.parse_dates(df, tv)
    return df if keep_order else df.drop(*ORDER)


def _read(spark, meta: dict, file_spec, county, data_dir, paths, **kw) -> DataFrame:
    allowed = {"columns_to_drop", "categorical_var", "categorical_unknown", "time_var",
               "duplicate_check_columns", "dedup_rows", "encoding", "name_columns"}
    args = {k: v for k, v in meta.items() if k in allowed}
    args["key_columns"] = [meta[k] for k in ("person_ID", "person_enrollment_ID", "program_ID", "groupID_column",
                                               "collection_stage_column", "type_column") if k in meta]
    args["numeric_columns"] = list(meta.get("columns_to_take_max", []))
    args.update(kw)
    return read_table(spark, file_spec, county, data_dir, paths, **args)


def get_enrollment(spark, county=None, groups: bool = True, file_spec=None, data_dir=None,
                   paths=None, metadata=None, sort: bool = False, **kw) -> DataFrame:
    """Enrollments, optionally only households with more than one row (A1)."""
    meta = _meta(metadata or hmis_config.ENROLLMENT)
    df = _read(spark, meta, file_spec or "Enrollment.csv", county, data_dir, paths, **kw)
    group = meta["groupID_column"]
    if groups:
        df = ag.groups_only(df, group)
    return df.orderBy(group) if sort else df


def get_exit(spark, county=None, file_spec=None, data_dir=None, paths=None, metadata=None,
             destination_map=None, **kw) -> DataFrame:
    """Exits with destination labels (J1), from a list of one's own if given."""
    meta = _meta(metadata or hmis_config.EXIT)
    df = _read(spark, meta, file_spec or "Exit.csv", county, data_dir, paths, **kw)
    return joins.merge_destination(df, meta["destination_column"], destination_map)


def get_client(spark, county=None, file_spec=None, data_dir=None, paths=None, metadata=None,
               name_exclusion: bool = False, agreeing_codes_survive: bool = False,
               keep_order: bool = False, **kw) -> DataFrame:
    """Clients; conflicting values per person resolved (D4-D7), names screened."""
    meta = _meta(metadata or hmis_config.CLIENT)
    if "person_ID" not in meta:
        raise ValueError("person_ID entry must be present in metadata file")
    pid = meta["person_ID"]
    keys = list(meta.get("duplicate_check_columns", []))
    bools = list(meta.get("boolean", []))
    nums = list(meta.get("numeric_code", []))
    if not bools:
        warnings.warn("boolean_cols is None")
    if not nums:
        warnings.warn("numeric_cols is None")
    dob = meta.get("dob_column")
    times = list(meta.get("time_var", []))
    mid = list(dict.fromkeys(keys + times + bools + nums + [pid]))
    df = _read(spark, {**meta, "duplicate_check_columns": mid}, file_spec or "Client.csv",
               county, data_dir, paths, keep_order=True, **kw)
    present = set(df.columns)
    df = dedup.resolve_conflicts(
        df, pid, time_cols=[c for c in times if c != dob and c in present],
        bool_cols=[c for c in bools if c in present], code_cols=[c for c in nums if c in present],
        agreeing_codes_survive=agreeing_codes_survive)
    df = dedup.keep_last(df, keys, ORDER)
    if name_exclusion:
        df = rc.exclude_names(df, list(meta.get("name_columns", [])))
    return df if keep_order else df.drop(*ORDER)


def _stage_meta(meta: dict) -> dict:
    need = ["collection_stage_column", "entry_stage_val", "exit_stage_val", "update_stage_val",
            "annual_assessment_stage_val", "post_exit_stage_val", "person_enrollment_ID"]
    for k in need:
        if k not in meta:
            raise ValueError(k + " entry must be present in metadata file")
    return meta


def read_entry_exit_table(spark, metadata, county=None, file_spec=None, data_dir=None, paths=None,
                          suffixes=codes.ENTRY_EXIT_SUFFIX, keep_order: bool = False,
                          observation: Observation | None = None, **kw) -> DataFrame:
    """R2: read, keep entry and exit stage rows, one column set per stage.

    ``observation`` receives the number of rows with an unlisted stage (P6).
    """
    meta = _stage_meta(_meta(metadata))
    df = _read(spark, meta, file_spec, county, data_dir, paths, keep_order=keep_order, **kw)
    df = _numeric(df, meta["collection_stage_column"])
    return reshape.entry_exit_wide(df, meta["collection_stage_column"], meta["entry_stage_val"],
                                   meta["exit_stage_val"], meta["person_enrollment_ID"], suffixes,
                                   listed=[meta[k] for k in ("update_stage_val", "annual_assessment_stage_val", "post_exit_stage_val")],
                                   observation=observation)


def _numeric(df: DataFrame, column: str) -> DataFrame:
    """A stage or type column as numbers; other text is no listed value."""
    if dict(df.dtypes)[column] != "string":
        return df
    return df.withColumn(column, F.trim(F.col(column)).try_cast("double"))


def get_disabilities(spark, county=None, file_spec=None, data_dir=None, paths=None, metadata=None,
                     disability_types=codes.DISABILITY_TYPES, disability_type_file=None,
                     one_row: bool = False, **kw) -> DataFrame:
    """``<Type>_entry`` / ``<Type>_exit`` per enrollment (R3; ``one_row`` as there)."""
    meta = _stage_meta(_meta(metadata or hmis_config.DISABILITIES))
    for k in ("type_column", "response_column"):
        if k not in meta:
            raise ValueError(k + " entry must be present in metadata file")
    df = _read(spark, meta, file_spec or "Disabilities.csv", county, data_dir, paths, **kw)
    enr, st, ty, rs = (meta["person_enrollment_ID"], meta["collection_stage_column"],
                       meta["type_column"], meta["response_column"])
    if disability_type_file:
        disability_types = joins.mapping_file(spark, disability_type_file)
    df = _numeric(_numeric(df, ty), st)
    return reshape.type_stage_wide(df, enr, st, ty, rs, meta["entry_stage_val"], meta["exit_stage_val"],
                                   disability_types, one_row=one_row)


def get_employment_education(spark, county=None, file_spec=None, data_dir=None, paths=None,
                             metadata=None, **kw) -> DataFrame:
    """E5."""
    meta = _stage_meta(_meta(metadata or hmis_config.EMPLOYMENT_EDUCATION))
    return read_entry_exit_table(spark, meta, county, file_spec or "EmploymentEducation.csv", data_dir, paths, **kw)


def get_health_dv(spark, county=None, file_spec=None, data_dir=None, paths=None, metadata=None,
                  **kw) -> DataFrame:
    """E6."""
    meta = _stage_meta(_meta(metadata or hmis_config.HEALTH_DV))
    return read_entry_exit_table(spark, meta, county, file_spec or "HealthAndDV.csv", data_dir, paths, **kw)


def get_income(spark, county=None, file_spec=None, data_dir=None, paths=None, metadata=None,
               **kw) -> DataFrame:
    """R2, then the max of the listed columns per enrollment (A3); other
    columns keep the first row's value (in file order)."""
    meta = _meta(metadata or hmis_config.INCOME)
    if "columns_to_take_max" not in meta:
        raise ValueError("columns_to_take_max entry must be present in metadata file")
    meta = _stage_meta(meta)
    enr = meta["person_enrollment_ID"]
    wide = read_entry_exit_table(spark, meta, county, file_spec or "IncomeBenefits.csv", data_dir, paths,
                                 keep_order=True, **kw)
    sfx = codes.ENTRY_EXIT_SUFFIX
    order_cols = [f"{c}{s}" for s in sfx[:2] for c in ORDER]
    wide = wide.withColumn("_first_ord", F.struct(*[F.col(c) for c in order_cols])).drop(*order_cols)
    max_cols = [f"{c}{s}" for s in sfx for c in meta["columns_to_take_max"]]
    return ag.max_per_key(wide, enr, max_cols, ["_first_ord"])


def get_project(spark, county=None, file_spec=None, data_dir=None, paths=None, metadata=None,
                project_type_file=None, **kw) -> DataFrame:
    """Projects with the type label (P8 + J2)."""
    meta = _meta(metadata or hmis_config.PROJECT)
    df = _read(spark, meta, file_spec or "Project.csv", county, data_dir, paths, **kw)
    return joins.label_project_type(df, meta["project_type_column"], project_type_file)


def merge_tables(spark, county=None, meta_files: Mapping | None = None, data_dir=None, paths=None,
                 files: Mapping | None = None, groups: bool = True, name_exclusion: bool = False,
                 observation: Observation | None = None, row_counts: dict | None = None,
                 **kw) -> DataFrame:
    """The wide table, one row per person and enrollment.

    A missing entry in ``meta_files`` or ``files`` falls back to the
    default configuration / file name.  ``observation`` (optional) receives
    the number of bad birth dates (D10) when the result is computed.
    ``row_counts`` (optional dict) is filled with one ``Observation`` per
    table whose ``n_rows`` is known after the first action (A5); no extra
    count jobs run.
    """

    def counted(name: str, df: DataFrame) -> DataFrame:
        if row_counts is None:
            return df
        obs = Observation(f"rows_{name}")
        row_counts[name] = obs
        return df.observe(obs, F.count(F.lit(1)).alias("n_rows"))

    meta_files = dict(meta_files or {})
    files = dict(files or {})

    def m(name):
        return _meta(meta_files.get(name) or hmis_config.METADATA[name])

    def f(name):
        return files.get(name) or hmis_config.DEFAULT_FILES[name]

    common = dict(county=county, data_dir=data_dir, paths=paths, **kw)
    em = m("enrollment")
    enroll = counted("enrollment", get_enrollment(spark, groups=groups, file_spec=f("enrollment"),
                                                  metadata=em, **common))
    enr_id, pid, prid, entry = (em["person_enrollment_ID"], em["person_ID"], em["program_ID"],
                                em["entry_date"])
    xm = m("exit")
    exits = counted("exit", get_exit(spark, file_spec=f("exit"), metadata=xm, **common))
    merged = joins.safe_join(enroll, exits, enr_id, xm["person_enrollment_ID"], "left")

    cm = m("client")
    client = get_client(spark, file_spec=f("client"), metadata=cm, name_exclusion=name_exclusion,
                        keep_order=True, **common)
    cpid, dob = cm["person_ID"], cm["dob_column"]
    first = ag.earliest_per_key(merged.select(F.col(pid).alias(cpid), entry), cpid, entry)
    if observation is not None:
        flag = dedup.bad_date_flag(client.join(first, cpid, "left"), cpid, dob, first)
        client = client.join(first, cpid, "left").observe(
            observation, F.sum(flag.cast("int")).alias("n_bad_dob")).drop("first_entry")
    client = dedup.null_bad_dates(client, cpid, dob, first)
    client = dedup.reconcile_dates(client, cpid, dob, list(cm["duplicate_check_columns"]), ORDER)
    client = counted("client", client.drop(*ORDER))
    merged = joins.safe_join(merged, client, pid, cpid, "right")

    for name, getter in (("disabilities", get_disabilities),
                         ("employment_education", get_employment_education),
                         ("health_dv", get_health_dv), ("income", get_income)):
        tm = m(name)
        t = counted(name, getter(spark, file_spec=f(name), metadata=tm, **common))
        merged = joins.safe_join(merged, t, enr_id, tm["person_enrollment_ID"], "left")

    pm = m("project")
    project = counted("project", get_project(spark, file_spec=f("project"), metadata=pm, **common))
    return joins.safe_join(merged, project, prid, pm["program_ID"], "left")


def merge_counts(spark, **how) -> tuple[DataFrame, DataFrame]:
    """E9 written once, and what was counted on the way (A5, D10) as ``metric, n`` rows.

    Nothing is computed a second time for a count.
    """
    bad, counts = Observation("bad_dob"), {}
    merged, _ = materialize(merge_tables(spark, observation=bad, row_counts=counts, **how), "merged")
    found = [(f"rows_{name}", seen.get["n_rows"]) for name, seen in counts.items()] + [("n_bad_dob", bad.get["n_bad_dob"] or 0)]
    return merged, spark.createDataFrame(found, "metric string, n long")
