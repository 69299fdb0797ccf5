"""The SQL each query must agree with, for DuckDB over the same tables."""

from __future__ import annotations

from tidemark.functions.keyed_uuid import hmac_pads
from workload.tables import CUT, SECRET

_INNER, _OUTER = hmac_pads(SECRET)


def uuid(text: str) -> str:
    inner = f"sha256(unhex('{_INNER}') || encode(coalesce({text}, 'None')))"
    h = f"sha256(unhex('{_OUTER}') || unhex({inner}))"
    return (
        f"list_transform([{h}], lambda d: substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-4' || substr(d, 14, 3)"
        " || '-' || translate(substr(d, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
        " || substr(d, 18, 3) || '-' || substr(d, 21, 12))[1]"
    )


def pages(keys: str) -> str:
    """Keys with their page, 499 to a page."""
    return (
        "select cast((row_number() over (order by substr(md5(id), 1, 3), id) - 1) // 499 + 1 as bigint) as page, id"
        f" from {keys}"
    )


def latest(rows: str) -> str:
    return f"""select * from {rows} qualify row_number() over (
        partition by id, code order by created_at desc nulls last, part_id desc nulls last,
        supp_id desc nulls last, group_id desc nulls last, description desc nulls last) = 1"""


SHA2 = "sha256(concat_ws('||', code, id, group_id))"
ROW = "id, code, group_id, created_at, description, part_id, supp_id"

CTES = {
    "raw": """select cast(l_orderkey as varchar) as id, cast(nullif(l_linenumber, 7) as varchar) as code,
        l_suppkey % 3 as group_id, l_shipdate as created_at, nullif(l_returnflag, 'R') as description,
        l_partkey as part_id, l_suppkey as supp_id from lineitem""",
    "earlier_raw": f"select * from raw where created_at < timestamp '{CUT}'",
    "batch_raw": f"select * from raw where created_at >= timestamp '{CUT}'",
    "earlier": f"select * from ({latest('earlier_raw')}) where description is not null and code is not null",
    "batch": f"select * from ({latest('batch_raw')}) where description is not null and code is not null",
    "cleaned": f"select * from ({latest('raw')}) where description is not null and code is not null",
    "state": f"select id, code, {SHA2} as sha2 from earlier",
    "new_state": f"select id, code, {SHA2} as sha2 from batch",
    "service": f"""select cast(o_orderkey as varchar) as id, {uuid('cast(o_orderkey as varchar)')} as uuid,
        o_orderstatus from orders where o_orderstatus <> 'P'""",
    "cache": "select uuid, id, '1999-12-31_1' as partition_ref from service",
    "small_cache": "select uuid, id, '1999-12-31_1' as partition_ref from service where o_orderstatus = 'F'",
    "tagged": f"""select b.*, case when s.sha2 is null then 'new' when b.sha2 <> s.sha2 then 'changed'
        else 'repeated' end as change
        from (select *, {SHA2} as sha2 from batch) b left join state s using (id, code)""",
    "unseen": "select distinct id from cleaned where id not in (select id from small_cache)",
    "order_ids": "select cast(o_orderkey as varchar) as id from orders",
    "parsed": f"""select uuid, id, '2000-01-01_' || page as partition_ref
        from ({pages('order_ids')}) join service using (id)""",
    # Two whole runs, the second over the first one's state and cache.
    "ids1": "select distinct id from earlier",
    "answers1": f"""select uuid, id, '2024-05-09_' || page as partition_ref
        from ({pages('ids1')}) join service using (id)""",
    "state1": "select s.* from state s join answers1 using (id)",
    "staged2": f"""select b.* from (select *, {SHA2} as sha2 from batch) b
        left join state1 s using (id, code) where s.sha2 is null or s.sha2 <> b.sha2""",
    "ids2": "select distinct id from staged2 where id not in (select id from answers1)",
    "answers2": f"""select * from answers1 union all select uuid, id, '2024-05-10_' || page as partition_ref
        from ({pages('ids2')}) join service using (id)""",
    "output2": "select s.*, a.uuid as answer, a.partition_ref from staged2 s join answers2 a using (id)",
    "state2": """select id, code, coalesce(n.sha2, c.sha2) as sha2
        from state1 c full join (select id, code, sha2 from output2) n using (id, code)""",
    "staged3": f"""select b.* from (select *, {SHA2} as sha2 from batch) b
        left join state2 s using (id, code) where s.sha2 is null or s.sha2 <> b.sha2""",
    "recent": """select distinct cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
        cast(day(ts) as integer) as day from events where cast(ts as date) > date '2024-01-24'""",
}


def sql(select: str) -> str:
    """The select under the named tables it needs."""
    needed: list[str] = []

    def need(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name, body in CTES.items():
            if name in words and name not in needed:
                need(body)
                needed.append(name)

    need(select)
    if not needed:
        return select
    return "with " + ",\n".join(f"{n} as materialized ({CTES[n]})" for n in needed) + "\n" + select


CLEANUP_COUNTERS = f"""select (select count(*) from {{0}}) as raw_count,
    (select count(*) from {{0}}) - count(*) as duplicated_count, count(*) as de_duplicated_count,
    count(*) filter (description is null) as no_description,
    count(*) filter (description is not null) as description_count,
    count(*) filter (description is not null and code is null) as no_code_count,
    count(*) filter (description is not null and code is not null) as code_count,
    count(*) filter (description is not null and code is not null) as valid_rows"""


def report(staged: str, matched: str) -> str:
    """A run's report over this run's rows, from its staged and matched rows."""
    counters = {
        ("load", "row_count"): "(select count(*) from batch_raw)",
        **{
            ("cleanup", name): f"(select {name} from c)"
            for name in (
                "raw_count",
                "duplicated_count",
                "de_duplicated_count",
                "no_description",
                "description_count",
                "no_code_count",
                "code_count",
                "valid_rows",
            )
        },
        ("process", "raw_count"): "(select count(*) from batch)",
        ("process", "new_count"): f"(select count(*) from {staged} )",
        ("process", "repeated_count"): f"(select count(*) from batch) - (select count(*) from {staged} )",
        ("process", "not_matched_count"): f"(select count(*) from {staged} ) - ({matched})",
        **{("process", name): f"({matched})" for name in ("matched_count", "transformed_count", "valid_rows")},
        **{("persist", name): f"({matched})" for name in ("raw_count", "valid_rows")},
    }
    texts = {
        ("load", "date_ref"): "'2024-05-10'",
        ("load", "predicate"): "'year=2024 and month=05 and day=10'",
        **{(s, "status"): "'success'" for s in ("load", "cleanup", "process", "persist")},
    }
    texts[("run", "status")] = "'success'"
    texts[("run", "additional_info")] = "null"
    rows = [f"select '{s}' as section, '{n}' as name, cast({v} as varchar) as value" for (s, n), v in {**counters, **texts}.items()]
    counted = f"{CLEANUP_COUNTERS.format('batch_raw')} from ({latest('batch_raw')})"
    return f"select r.* from (with c as ({counted}) " + " union all ".join(rows) + ") r"


ORACLE = {
    "workday_anchor": """select day, day - cast(greatest(isodow(day) - 5, 0) as integer) as anchor
        from (select distinct cast(o_orderdate as date) as day from orders)""",
    "recent_partitions": sql("select * from recent"),
    "latest_partition": sql(
        """select date_ref, 'year=' || strftime(date_ref, '%Y') || ' and month=' || strftime(date_ref, '%m')
        || ' and day=' || strftime(date_ref, '%d') as predicate from (select coalesce(
        max(make_date(year, month, day)), date '2024-01-26') as date_ref from recent )"""
    ),
    "latest_partition_scan": """select *, cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
        cast(day(ts) as integer) as day from events where cast(ts as date) = (select max(cast(ts as date))
        from events where cast(ts as date) > date '2024-01-24' and cast(ts as date) <= date '2024-01-28')""",
    "catalog_partitions": """select distinct cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
        cast(day(ts) as integer) as day from events""",
    "view_scan": sql("select * from raw"),
    "dedup_latest": sql(latest("raw")),
    "dedup_discarded": sql(f"select * from raw except all ({latest('raw')})"),
    "require_description": sql("select * from raw where description is not null"),
    "require_code": sql("select * from raw where code is not null"),
    "cleanup": sql(f"select * from ({latest('raw')}) where description is not null and code is not null"),
    "cleanup_report": sql(f"{CLEANUP_COUNTERS.format('raw')} from ({latest('raw')})"),
    "row_fingerprint": """select doc_id, sha256(concat_ws('||', lang, nullif(source, 'web'), doc_id, text)) as sha2
        from documents""",
    "row_fingerprint_null_token": sql(
        r"""select id, code, created_at,
        sha256(concat_ws('||', coalesce(code, '\N'), coalesce(description, '\N'), id)) as sha2 from raw"""
    ),
    "keyed_uuid": f"select cast(o_orderkey as varchar) as id, {uuid('cast(o_orderkey as varchar)')} as uuid from orders",
    "keyed_uuid_sql": f"""select doc_id, {uuid('text')} as uuid, {uuid("nullif(lang, 'en')")} as lang_uuid
        from documents""",
    "derive_entity_id": f"""select id, code, {uuid(f"{uuid('id')} || '||' || code")} as uuid from (select distinct
        cast(l_orderkey as varchar) as id, cast(l_linenumber as varchar) as code from lineitem)""",
    "change_detect": sql("select * from tagged"),
    "rows_to_save": sql("select * exclude (change) from tagged where change <> 'repeated'"),
    "change_detect_by_code": sql(
        f"""select n.*, case when c.sha2 is null or c.sha2 <> n.sha2 then 'save' else 'skip' end as state,
        count(*) as copies
        from (select *, {SHA2} as sha2 from (select * replace (cast(part_id as varchar) as code) from batch )) n
        left join (select code, {SHA2} as sha2 from (select * replace (cast(part_id as varchar) as code) from earlier )) c
        using (code) group by all"""
    ),
    "state_upsert": sql(
        """select id, code, coalesce(n.sha2, c.sha2) as sha2
        from state c full join new_state n using (id, code)"""
    ),
    "state_upsert_by_id": sql(
        """select id, code, sha2, count(*) as copies from (select id, coalesce(n.code, c.code) as code,
        coalesce(n.sha2, c.sha2) as sha2 from state c full join new_state n using (id)) group by all"""
    ),
    "bootstrap_empty_state": sql(f"select *, {SHA2} as sha2, 'new' as change from cleaned"),
    "unseen_keys": sql("select * from unseen"),
    "lookup_batches": sql(pages("unseen")),
    "parse_lookup_response": sql("select * from parsed"),
    "lookup_function": sql(f"""select {uuid('id')} as uuid, id, '2000-01-01_' || page as partition_ref
        from ({pages('unseen')})"""),
    "cache_append_roundtrip": sql("select * from small_cache union all select * from parsed"),
    "latest_answers": f"""select uuid, id, strftime(ts, '%Y-%m-%d') || '_' || hour(ts) as partition_ref from (
        select ts, cast(user_id as varchar) as id, {uuid('cast(event_id as varchar)')} as uuid from events)
        qualify row_number() over (partition by id order by cast(ts as date) desc, hour(ts) desc, uuid desc) = 1""",
    "lookup_enrich": sql(
        f"""select b.*, a.uuid, a.partition_ref, if(a.uuid is null, 'skipped', 'save') as state
        from cleaned b left join (select * from small_cache union all
        select uuid, id, '2000-01-01_' || page as partition_ref from ({pages('unseen')})
        join service using (id)) a using (id)"""
    ),
    "enrich_tagged": sql(
        """select b.*, uuid, partition_ref, if(uuid is null, 'skipped', 'save') as state
        from cleaned b left join cache using (id)"""
    ),
    "lookup_retry": sql(
        f"""select b.*, a.uuid, a.partition_ref, if(a.uuid is null, 'skipped', 'save') as state
        from cleaned b left join (select s.uuid, id, '2000-01-01_' || page as partition_ref
        from ({pages('(select distinct id from cleaned )')}) join service s using (id) where o_orderstatus = 'F') a using (id)"""
    ),
    "enrich_matched": sql("select b.*, uuid, partition_ref from cleaned b join cache using (id)"),
    "enrich_unmatched": sql("select * from cleaned where id not in (select id from cache )"),
    "enrich_full_outer": sql(
        """select id, code, group_id, created_at, description, part_id, supp_id, uuid, partition_ref,
        if(uuid is null, 'skipped', 'save') as state, count(*) as copies from cleaned full join (
        select * from cache union all select * from small_cache union all
        select null, cast(o_orderkey as varchar), '1999-12-31_2' from orders where o_orderstatus = 'P') using (id) group by all"""
    ),
    "enrich_documents": f"""select cast(d.doc_id as varchar) as id, text, lang, source, n_chars, uuid,
        if(uuid is null, null, '2024-05-10_1') as partition_ref, if(uuid is null, 'skipped', 'save') as state
        from documents d left join (select doc_id, {uuid("concat_ws('||', doc_id, quality, toxic)")} as uuid
        from labels) using (doc_id)""",
    "unmatched_sample": sql(
        """select id from cleaned where id not in (select id from cache ) order by id limit 20"""
    ),
    "process_report": sql(
        """select count(*) as raw_count, count(*) filter (change <> 'repeated') as new_count,
        count(*) filter (change = 'repeated') as repeated_count,
        count(*) filter (change <> 'repeated' and uuid is not null) as matched_count,
        count(*) filter (change <> 'repeated' and uuid is null) as not_matched_count,
        count(*) filter (change <> 'repeated' and uuid is not null) as transformed_count,
        count(*) filter (change <> 'repeated' and uuid is not null) as valid_rows
        from tagged left join cache using (id)"""
    ),
    "publish_output": sql(
        f"""select {uuid("uuid || '||' || code")} as uuid, id, code, group_id from cleaned join cache using (id)"""
    ),
    "incremental_run": sql(
        f"""select {ROW}, 2024 as year, 5 as month, 10 as day, sha2, {uuid("answer || '||' || code")} as uuid,
        partition_ref from output2"""
    ),
    "run_report": sql(report("staged2", "select count(*) from output2")),
    "incremental_rerun": sql("select * from state2"),
    "rerun_report": sql(report("staged3", "select count(*) from staged3 join answers2 using (id)")),
}
ORACLE["state_upsert_roundtrip"] = ORACLE["state_upsert"]
ORACLE["run_report_json"] = f"select * from ({ORACLE['run_report']}) where section <> 'run'"
ORACLE["error_report"] = """select * from (values ('run', 'status', 'error'),
    ('run', 'additional_info', 'run ''2024-05-09'' is already committed to the state'), ('load', 'status', 'unknown'),
    ('cleanup', 'status', 'unknown'), ('process', 'status', 'unknown'), ('persist', 'status', 'unknown')) r(section, name, value)"""
ORACLE["incremental_output"] = sql(f"""select {uuid("answer || '||' || code")} as uuid, id, code, group_id from output2""")
ORACLE["cleanup_pipeline"] = ORACLE["cleanup"]
ORACLE["incremental_pipeline"] = ORACLE["incremental_run"]

# The service that fails on even pages and on each fifth one, then a sound one.
GOOD = "page % 2 = 1 and page % 5 <> 0"
CTES["asked1"] = pages("unseen")
CTES["troubled1"] = f"select uuid, id, '2000-01-01_' || page as partition_ref from asked1 join service using (id) where {GOOD}"
CTES["unseen2"] = "select id from unseen where id not in (select id from troubled1 )"
CTES["sound2"] = f"""select uuid, id, '2000-01-01_' || page as partition_ref from ({pages('unseen2')}) join service using (id)"""


def _enriched(answers: str) -> str:
    return sql(
        f"""select b.*, a.uuid, a.partition_ref, if(a.uuid is null, 'skipped', 'save') as state
        from cleaned b left join (select * from small_cache union all {answers}) a using (id)"""
    )


ORACLE["lookup_malformed"] = _enriched("select * from troubled1")
ORACLE["lookup_malformed_retry"] = _enriched("select * from troubled1 union all select * from sound2")
ORACLE["lookup_report"] = sql(
    f"""select unnest([struct_pack(name := 'waves', value := (pages + 3) // 4), struct_pack(name := 'pages', value := pages),
        struct_pack(name := 'answered', value := answered), struct_pack(name := 'empty', value := good - answered),
        struct_pack(name := 'failed', value := failed), struct_pack(name := 'malformed', value := malformed),
        struct_pack(name := 'items_without_id', value := 0)], recursive := true)
        from (select count(*) as pages, count(*) filter ({GOOD}) as good, count(*) filter ({GOOD} and known) as answered,
        count(*) filter (page % 2 = 1 and page % 5 = 0) as failed, count(*) filter (page % 2 = 0) as malformed
        from (select page, bool_or(s.id is not null) as known from asked1 left join service s using (id) group by page))"""
)
ORACLE["malformed_pages"] = sql("select distinct page, '<html>busy</html>' as body from asked1 where page % 2 = 0")
ORACLE["page_waves"] = sql(
    f"""select (page - 1) // 4 as wave, count(distinct page) as pages, count(*) as ids
        from ({pages('order_ids')}) group by 1"""
)
ORACLE["resumed_run"] = ORACLE["run_report"]
ORACLE["resumed_output"] = ORACLE["incremental_run"]
ORACLE["dedup_latest_maps"] = """select user_id, cast(ts as date) as day, event_type as kind, props from events
    qualify row_number() over (partition by user_id order by cast(ts as date) desc, event_type desc, props desc) = 1"""
