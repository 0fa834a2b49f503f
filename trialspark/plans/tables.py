"""The given tables seen as clinical-trial tables.

The view texts are plain SQL that Spark and DuckDB read alike; ``$name`` stands for a table. ``$apart`` is
Spark's hint for joins with ``part``, and nothing in DuckDB.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession

from trialspark.session import cut_lineage

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# A part file under the broadcast limit unpacks to many times its size, and a query over all canonical tables
# would gather five such tables in the driver at once.
_APART = " /*+ shuffle_hash(part) */"
_PART = "$lineitem join $part on l_partkey = p_partkey"
_NCT = "concat('NCT', lpad(cast({} as string), 8, '0'))"
_ORDER_NCT = _NCT.format("o_orderkey")
_DATE = "cast(cast(o_orderdate as date) as string)"

VIEWS = {
    "sponsor": "select c_custkey as sponsor_id, c_name as sponsor_name, c_mktsegment as sponsor_type from $customer",
    "trial": f"""
        select o_orderkey as trial_id, {_ORDER_NCT} as nct_id, o_custkey as sponsor_id,
          case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'RECRUITING' else 'TERMINATED' end as overall_status,
          case when o_orderkey % 5 = 0 then 'OBSERVATIONAL' else 'INTERVENTIONAL' end as study_type,
          concat('PHASE_', cast(1 + o_orderkey % 4 as string)) as phase,
          cast(floor(o_totalprice / 1000) as int) as enrollment,
          cast(o_orderdate as date) as first_posted,
          cast(o_orderdate as date) + cast(o_orderkey % 400 as int) as last_update_posted,
          concat('snapshot-', cast(year(o_orderdate) as string)) as source_snapshot_id
        from $orders""",
    "arm": """
        select distinct l_orderkey * 10 + l_linenumber as arm_id, l_orderkey as trial_id,
          concat('Arm ', cast(l_linenumber as string)) as arm_label from $lineitem""",
    "intervention": f"""
        select$apart distinct l_orderkey * 10000000 + l_partkey as intervention_id, l_orderkey as trial_id,
          p_type as intervention_type, p_name as intervention_name from {_PART}""",
    "condition": f"""
        select$apart distinct l_orderkey as trial_id, concat(p_type, ' ', substr(p_brand, 7)) as condition_name
        from {_PART}""",
    "endpoint": f"""
        select$apart distinct l_orderkey as trial_id,
          case l_returnflag when 'A' then 'primary' when 'N' then 'secondary' else 'other' end as endpoint_type,
          p_brand as endpoint_name from {_PART}""",
    "biomarker": f"""
        select$apart distinct l_orderkey as trial_id, concat('BM-', cast(p_size as string)) as biomarker_name
        from {_PART} where p_size <= 20""",
    "publication": f"""
        select$apart l_orderkey * 10000000 + l_partkey as publication_id, l_orderkey as trial_id,
          concat('Journal ', substr(p_brand, 7)) as journal, p_name as title,
          min(cast(l_shipdate as date)) as published_at
        from {_PART} where l_linestatus = 'F' group by l_orderkey, l_partkey, p_brand, p_name""",
    "site": """
        select l_orderkey * 100000 + l_suppkey as site_id, l_orderkey as trial_id, s_name as facility_name,
          n_name as country, r_name as state,
          case when (l_orderkey + l_suppkey) % 23 = 0 then null
            else cast((l_suppkey * 7919 + l_orderkey * 31) % 12000 as double) / cast(100 as double) - 60 end as latitude,
          case when (l_orderkey + l_suppkey) % 23 = 0 then null
            else cast((l_suppkey * 104729 + l_orderkey * 17) % 36000 as double) / cast(100 as double) - 180 end as longitude
        from (select distinct l_orderkey, l_suppkey from $lineitem) li
          join $supplier on l_suppkey = s_suppkey join $nation on s_nationkey = n_nationkey
          join $region on n_regionkey = r_regionkey""",
    "document_chunk": f"""
        select doc_id as document_chunk_id, {_NCT.format("doc_id")} as nct_id, text as chunk_text,
          lang as country, source as study_phase, $sha256_text as source_content_sha256, embedding
        from $documents left join $embeddings on doc_id = vec_id""",
    "raw_csv": f"""
        select {_ORDER_NCT} as nct_number,
          case when o_orderkey % 7 = 0 then null else concat('Study ', cast(o_orderkey as string)) end as study_title,
          case o_orderstatus when 'F' then 'COMPLETED' when 'O' then 'RECRUITING' else null end as study_status,
          case o_orderkey % 3 when 0 then 'YES' when 1 then 'NO' else null end as study_results,
          concat(o_orderpriority, '|', o_orderstatus) as conditions,
          case when o_orderkey % 11 = 0 then 'n/a'
            else cast(cast(floor(o_totalprice / 1000) as int) as string) end as enrollment,
          case o_orderkey % 3 when 0 then substr({_DATE}, 1, 10) when 1 then substr({_DATE}, 1, 7)
            else concat(substr({_DATE}, 6, 2), '/', substr({_DATE}, 9, 2), '/', substr({_DATE}, 1, 4)) end as start_date
        from $orders where o_orderkey % 10 <> 0""",
    "raw_json": f"""
        select {_ORDER_NCT} as nct_id,
          concat('{{"protocolSection":{{"identificationModule":{{"nctId":"', {_ORDER_NCT}, '"',
            case when o_orderkey % 6 = 0 then '' else concat(',"officialTitle":"Official ', cast(o_orderkey as string), '"') end,
            '}},"designModule":{{"phases":["PHASE', cast(1 + o_orderkey % 4 as string), '"],"enrollmentInfo":{{"count":',
            cast(o_custkey as string), '}}}},"conditionsModule":{{"conditions":[',
            case when o_orderkey % 9 = 0 then '' else concat('"', o_orderpriority, '"') end,
            ']}}}},"hasResults":', case when o_orderkey % 2 = 0 then 'true' else 'false' end, '}}') as study_json
        from $orders where o_orderkey % 4 <> 0""",
    "updates": """
        select event_id, ts as updated_at, user_id as trial_id, event_type as op, value as enrollment,
          props as attributes from $events""",
}

CSV_HEADERS = {
    "nct_number": "NCT Number",
    "study_title": "Study Title",
    "study_status": "Study Status",
    "study_results": "Study Results",
    "conditions": "Conditions",
    "enrollment": "Enrollment",
    "start_date": "Start Date",
}


class Tables:
    """Tables and views of one data folder, built when first used: ``t.trial``, ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        names = {base: f"parquet.`{self.dir}/{base}.parquet`" for base in BASE}
        names["part"] += " as part"
        return self.spark.sql(Template(VIEWS[name]).substitute(names, apart=_APART, sha256_text="sha2(text, 256)"))

    def canonical(self) -> dict[str, DataFrame]:
        names = "trial sponsor arm intervention condition biomarker endpoint publication site".split()
        return {name: getattr(self, name) for name in names}

    def stored(self) -> dict[str, DataFrame]:
        """The canonical tables for jobs that read them often: what takes a shuffle to build is written once.

        Rows are written in the order of their trials, which packs ids into few bytes.
        """
        tables = self.canonical()
        built = {name: df for name, df in tables.items() if name not in ("trial", "sponsor")}
        return tables | {name: cut_lineage(df.sortWithinPartitions("trial_id"), "zstd") for name, df in built.items()}

    def csv_with_headers(self) -> DataFrame:
        return self.raw_csv.withColumnsRenamed(CSV_HEADERS)


def duck_views(*names: str) -> str:
    """``WITH`` clause that defines the views for DuckDB."""
    plain = {base: base for base in BASE}
    parts = [
        f"{name} AS ({Template(VIEWS[name]).substitute(plain, apart='', sha256_text='sha256(text)')})" for name in names
    ]
    return "WITH " + ",\n".join(parts)
