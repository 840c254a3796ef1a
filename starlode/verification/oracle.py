"""SQL twins of the queries, for DuckDB over the same Parquet files.

Only the shaping of the Bronze frames shares its text with the queries; every rule is
written again in SQL.
"""

from __future__ import annotations

from starlode.plans.entities import SILVER
from starlode.verification.frames import SHAPES

NI = "'NÃO INFORMADO'"


def _crc_table() -> str:
    """Remainders of all bytes for the reflected polynomial 0xEDB88320."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return f"{table}::BIGINT[]"


CRC_TABLE = _crc_table()


def crc(value: str) -> str:
    """crc32 of an ASCII text; null stays null."""
    text = f"cast({value} AS varchar)"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i::INT, 1))::BIGINT)"
    step = f"xor(a >> 8, ({CRC_TABLE})[(xor(a, b) & 255) + 1])"
    folded = f"list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {step})"
    return f"CASE WHEN {value} IS NULL THEN NULL ELSE xor({folded}, 4294967295::BIGINT) END"


def _quoted(name: str) -> str:
    return f'"{name}"'


def bronze_sql(entity: str) -> str:
    select, source, versions = SHAPES[entity]
    twice = " CROSS JOIN (VALUES (0), (1)) AS _versions(v)" if versions else ""
    return f"SELECT {select.replace(' AS order', ' AS "order"')} FROM {source}{twice}"


def newest_sql(source: str, key: str, order: list[str]) -> str:
    ranked = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {ranked}) AS _rn"
        f" FROM ({source})) WHERE _rn = 1"
    )


def deduplicated(entity: str) -> str:
    spec = SILVER[entity]
    order = [_quoted(c) for c in spec.types if c != spec.key]
    if spec.version:
        order.insert(0, f"try_cast({spec.version} AS timestamp)")
    return newest_sql(bronze_sql(entity), spec.key, order)


def _times(*names: str) -> str:
    return ", ".join(f"cast({n} AS timestamp) AS {n}" for n in names)


def _ints(kind: str, *names: str) -> str:
    return ", ".join(f'cast("{n}" AS {kind}) AS "{n}"' for n in names)


AUDIT = _times("createdAt", "updatedAt", "deletedAt")
UF = (
    "regexp_extract(address, '\\b(AC|AL|AP|AM|BA|CE|DF|ES|GO|MA|MT|MS|MG|PA|PB|PR|PE|PI|RJ|RN|RS|RO"
    "|RR|SC|SP|SE|TO)\\b', 1)"
)
CEP = "lpad(regexp_replace(regexp_extract(address, 'CEP(.*)', 1), '[^0-9]', '', 'g'), 8, '0')"


def _zero(name: str, kind: str) -> str:
    return f'coalesce(cast("{name}" AS {kind}), 0) AS "{name}"'


def _weight(name: str) -> str:
    return f"cast(coalesce(cast({name} AS decimal(10,2)), 0) AS decimal(12,2)) AS {name}"


def _or(name: str, default: str) -> str:
    return f"coalesce(nullif({name}, ''), '{default}') AS {name}"


SILVER_SELECT = {
    "checklists": f"""
        cast(checklistId AS bigint) AS checklistId, type, trim(upper(name)) AS name,
        trim(upper(coalesce(subject, {NI}))) AS subject,
        CASE WHEN trim(upper(description)) = '' THEN {NI} ELSE trim(upper(description)) END AS description,
        cast(active AS boolean) AS active, {AUDIT}""",
    "categories": f"""
        {_ints("bigint", "categoryId", "checklistId", "parentId")}, cast(type AS int) AS type,
        trim(upper(name)) AS name, description, {AUDIT}""",
    "items": f"""
        {_ints("bigint", "itemId", "checklistId", "categoryId")}, trim(upper(name)) AS name,
        {_times("deletedAt")}, cast("order" AS int) AS "order" """,
    "units": f"""
        cast(unitId AS bigint) AS unitId, name, email, cast(active AS boolean) AS active,
        cast(unitTypeId AS bigint) AS unitTypeId, {CEP} AS zipCode, address, number, complement,
        cast(countryId AS int) AS countryId,
        CASE WHEN stateId IS NULL THEN {UF} ELSE stateId END AS stateId,
        cast(cityId AS int) AS cityId, cast(latitude AS double) AS latitude,
        cast(longitude AS double) AS longitude, {AUDIT}""",
    "users": f"""
        cast(userId AS bigint) AS userId, trim(upper(name)) AS name, trim(lower(email)) AS email,
        cast(active AS boolean) AS active, cast(userTypeId AS bigint) AS userTypeId,
        regexp_replace(phone, '[^0-9]', '', 'g') AS phone,
        {_ints("int", "languageId", "countryId", "stateId")}, {AUDIT}""",
    "user_types": f"""
        cast(userTypeId AS bigint) AS userTypeId, trim(upper(name)) AS name,
        cast(active AS boolean) AS active, {AUDIT}""",
    "evaluations": f"""
        cast(evaluationId AS bigint) AS evaluationId, cast(status AS int) AS status,
        cast(score AS decimal(10,2)) AS score, {_ints("bigint", "checklistId", "unitId", "userId")},
        {_times("startedAt", "concludedAt", "approvedAt")}, platform,
        cast(scheduled AS boolean) AS scheduled, {_times("scheduleStartDate", "scheduleEndDate")},
        trim(upper(coalesce(nullif(finalComment, ''), {NI}))) AS finalComment,
        trim(upper(coalesce(nullif(sharedTo, ''), {NI}))) AS sharedTo,
        cast(countAttachments AS int) AS countAttachments,
        {_ints("double", "initialLatitude", "initialLongitude", "finalLatitude", "finalLongitude")},
        {AUDIT}""",
    "evaluations_results": f"""
        {_ints("bigint", "resultId", "evaluationId", "categoryId", "itemId", "scaleId")},
        {_times("answeredAt")}, coalesce(try_cast(evaluative AS int), 0) AS evaluative,
        {_or("sharedTo", "NÃO COMPARTILHADO")}, {_or("text", "SEM RESPOSTA")},
        {_zero("number", "double")}, {_ints("int", "stateId", "cityId")}, product,
        cast(competencePeriodId AS bigint) AS competencePeriodId,
        CASE WHEN selectedOptions IS NULL OR selectedOptions IN ('[]', '') THEN {NI}
             ELSE selectedOptions END AS selectedOptions,
        {_zero("index", "int")}, {_weight("originalWeight")}, {_weight("maximumWeight")},
        {_weight("obtainedWeight")}, {_or("comment", "SEM COMENTÁRIO")},
        {_zero("countAttachments", "int")}, {_zero("countSignatures", "int")},
        {_ints("int", "itemOrder", "categoryOrder")}""",
}


def silver_sql(entity: str) -> str:
    return f"SELECT {SILVER_SELECT[entity]} FROM ({deduplicated(entity)})"


def newest_silver(entity: str) -> str:
    spec = SILVER[entity]
    order = ["updatedAt", *[_quoted(c) for c in spec.types if c != spec.key]]
    return newest_sql(silver_sql(entity), spec.key, order)


STATUS_NAME = """CASE {0} WHEN 1 THEN 'NÃO INICIADO' WHEN 2 THEN 'EM ANDAMENTO' WHEN 3 THEN 'EM ANÁLISE'
    WHEN 4 THEN 'REPROVADO' WHEN 5 THEN 'REABERTO' WHEN 6 THEN 'CONCLUÍDO' ELSE 'DESCONHECIDO' END"""
PLATFORM_NAME = """CASE try_cast({0} AS int) WHEN 1 THEN 'WEB' WHEN 2 THEN 'ANDROID' WHEN 3 THEN 'IOS'
    ELSE 'DESCONHECIDA' END"""
GONE = "CASE WHEN deletedAt IS NULL THEN 'Ativ{0}' ELSE 'Inativ{0}' END"

DIMS = {
    "dim_status": f"""
        SELECT DISTINCT {crc("status")} AS sk_status, status AS id_original_status,
               {STATUS_NAME.format("status")} AS nome_status
        FROM ({silver_sql("evaluations")})""",
    "dim_plataforma": f"""
        SELECT DISTINCT {crc("platform")} AS sk_plataforma, platform AS id_original_plataforma,
               {PLATFORM_NAME.format("platform")} AS nome_plataforma
        FROM ({silver_sql("evaluations")})""",
    "dim_checklists": f"""
        SELECT {crc("checklistId")} AS sk_checklist, checklistId AS id_original_checklist,
               name AS nome_checklist, subject AS assunto, description AS descricao,
               {GONE.format("o")} AS status_checklist, createdAt AS dt_criacao,
               updatedAt AS dt_atualizacao, deletedAt AS dt_delecao
        FROM ({newest_silver("checklists")})""",
    "dim_unidades": f"""
        SELECT {crc("unitId")} AS sk_unidade, unitId AS id_original_unidade, name AS nome_unidade,
               email AS email_unidade, {GONE.format("a")} AS status_unidade, zipCode AS CEP,
               address AS endereco, number AS numero, complement AS complemento, stateId AS estado,
               latitude, longitude, createdAt AS dt_criacao, updatedAt AS dt_ultima_atualizacao,
               deletedAt AS dt_delecao
        FROM ({newest_silver("units")})""",
    "dim_usuario": f"""
        SELECT {crc("u.userId")} AS sk_usuario, u.userId AS id_original_usuario, u.name AS nome_usuario,
               u.email AS email_usuario, {GONE.format("o").replace("deletedAt", "u.deletedAt")} AS status_usuario,
               t.name AS tipo_usuario, u.phone AS telefone, u.createdAt AS dt_criacao,
               u.updatedAt AS dt_ultima_atualizacao, u.deletedAt AS dt_delecao
        FROM ({newest_silver("users")}) u JOIN ({silver_sql("user_types")}) t ON u.userTypeId = t.userTypeId""",
    "dim_categorias": f"""
        SELECT {crc("categoryId")} AS sk_categoria, categoryId AS id_original_categoria,
               checklistId AS id_checklist, parentId AS id_categoria_pai, type AS tipo_categoria,
               name AS nome_categoria, description AS descricao_categoria, createdAt AS dt_criacao,
               updatedAt AS dt_atualizacao, deletedAt AS dt_delecao
        FROM ({silver_sql("categories")})""",
    "dim_itens": f"""
        SELECT {crc("itemId")} AS sk_item, itemId AS id_original_item, checklistId AS id_checklist,
               categoryId AS id_categoria, name AS nome_item, deletedAt AS dt_delecao,
               "order" AS ordem_item
        FROM ({silver_sql("items")})""",
}

APPLIED = f"""
    SELECT {crc("evaluationId")} AS sk_checklist_aplicado, evaluationId AS id_original_checklist_aplicado,
           sk_status, sk_plataforma, sk_checklist, sk_unidade, sk_usuario,
           cast(coalesce(score, 0) AS decimal(12,2)) AS pontuacao, finalComment AS comentarios_finais,
           sharedTo AS compartilhado_com, countAttachments AS qtd_anexos,
           CASE WHEN scheduled THEN 'SIM' ELSE 'NÃO' END AS agendado, startedAt AS iniciado_em,
           concludedAt AS concluido_em, approvedAt AS aprovado_em,
           scheduleStartDate AS dt_inicio_agendamento, scheduleEndDate AS dt_fim_agendamento,
           initialLatitude AS latitude_inicial, initialLongitude AS longitude_inicial,
           finalLatitude AS latitude_final, finalLongitude AS longitude_final,
           createdAt AS criado_em, updatedAt AS atualizado_em, deletedAt AS deletado_em
    FROM ({silver_sql("evaluations")}) a
    LEFT JOIN ({DIMS["dim_status"]}) b ON a.status = b.id_original_status
    LEFT JOIN ({DIMS["dim_plataforma"]}) c ON a.platform = c.id_original_plataforma
    LEFT JOIN (SELECT id_original_checklist, sk_checklist FROM ({DIMS["dim_checklists"]})) d
           ON a.checklistId = d.id_original_checklist
    LEFT JOIN (SELECT id_original_unidade, sk_unidade FROM ({DIMS["dim_unidades"]})) e
           ON a.unitId = e.id_original_unidade
    LEFT JOIN (SELECT id_original_usuario, sk_usuario FROM ({DIMS["dim_usuario"]})) f
           ON a.userId = f.id_original_usuario"""

RESULTS = f"""
    SELECT {crc("resultId")} AS sk_resultado, resultId AS id_original_resultado,
           sk_checklist_aplicado, sk_categoria, sk_item, scaleId AS id_escala,
           answeredAt AS respondido_em, evaluative AS avaliativo, sharedTo AS compartilhado_com,
           text AS texto_avaliacao, number AS numero, stateId AS id_estado, cityId AS id_cidade,
           product AS produto, competencePeriodId AS id_competencia,
           selectedOptions AS opcoes_selecionadas, "index" AS indice, originalWeight AS peso_original,
           maximumWeight AS peso_maximo, obtainedWeight AS peso_obtido, comment AS comentario,
           countAttachments AS qtd_anexos, countSignatures AS qtd_assinaturas,
           itemOrder AS ordem_item, categoryOrder AS ordem_categoria
    FROM ({silver_sql("evaluations_results")}) a
    LEFT JOIN (SELECT id_original_item, sk_item FROM ({DIMS["dim_itens"]})) b ON a.itemId = b.id_original_item
    LEFT JOIN (SELECT id_original_categoria, sk_categoria FROM ({DIMS["dim_categorias"]})) c
           ON a.categoryId = c.id_original_categoria
    LEFT JOIN (SELECT id_original_checklist_aplicado, sk_checklist_aplicado FROM ({APPLIED})) d
           ON a.evaluationId = d.id_original_checklist_aplicado"""

_HALF = "(SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)"
_REMARK = """(SELECT o_orderkey, CASE o_orderkey % 4 WHEN 1 THEN '' WHEN 2 THEN '   '
    WHEN 3 THEN ' n ' || o_orderpriority END AS remark FROM orders)"""
_EVENTS_TEXT = (
    "SELECT cast(event_id AS varchar) AS event_id, cast(ts AS varchar) AS ts,"
    " cast(user_id AS varchar) AS user_id, event_type FROM events"
)
_UNITS = f"(SELECT DISTINCT unitId, address, stateId FROM ({bronze_sql('units')}))"
_LINE_IDS = "(SELECT l_orderkey * 10 + l_linenumber AS line_id FROM lineitem)"
_BALANCE = "CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END"
_TURNS = "SELECT conv_id, turn, role FROM conversations"

ORACLE: dict[str, str] = {
    "land_pages": _TURNS,
    "single_envelope": "SELECT conv_id, turn, role, cast(NULL AS varchar) AS absent FROM conversations",
    "child_scan_parent_stamp": _TURNS,
    "distinct_parent_list": "SELECT DISTINCT l_orderkey FROM lineitem",
    "missing_children": """
        SELECT DISTINCT doc_id FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "page_completeness": """
        SELECT conv_id, count(*) AS pages, NOT bool_and(role <> 'system') AS complete
        FROM conversations GROUP BY conv_id""",
    "bronze_stringify": """
        SELECT cast(o_orderkey AS varchar) AS o_orderkey, cast(o_custkey AS varchar) AS o_custkey,
               o_orderstatus, cast(o_totalprice AS varchar) AS o_totalprice,
               cast(NULL AS varchar) AS o_absent FROM orders""",
    "table_scan": "SELECT * FROM supplier",
    "sql_scan": "SELECT * FROM part",
    "temp_view_sql": "SELECT c_custkey, trim(upper(c_mktsegment)) AS segment, c_acctbal FROM customer",
    "watermark_max": "SELECT max(cast(ts AS varchar)) AS watermark FROM events",
    "incremental_filter": f"""
        SELECT * FROM ({_EVENTS_TEXT})
        WHERE ts > (SELECT max(cast(ts AS varchar)) FROM events WHERE ts <= {_HALF})""",
    "incremental_append": _EVENTS_TEXT,
    "full_overwrite": "SELECT * FROM customer",
    "load_type_cases": """
        SELECT * FROM (VALUES ('forced', 'FULL'), ('missing table', 'FULL'), ('no column', 'FULL'),
                              ('null maximum', 'FULL'), ('incremental', 'INCREMENTAL')) AS c(load_case, mode)
        LEFT JOIN (SELECT 'INCREMENTAL' AS mode, max(cast(ts AS varchar)) AS watermark FROM events)
        USING (mode)""",
    "table_exists": "SELECT true AS there, false AS elsewhere, count(*) AS n_rows FROM orders",
    "row_count_metric": "SELECT count(*) AS n_rows FROM lineitem",
    "audit_clock": """
        SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/Sao_Paulo' AS local_ts FROM events""",
    "typed_projection": """
        SELECT l_orderkey, l_linenumber, cast(cast(l_extendedprice AS varchar) AS decimal(10,2)) AS price,
               cast(cast(l_shipdate AS varchar) AS timestamp) AS shipped, l_quantity AS quantity,
               l_linestatus = 'O' AS is_open FROM lineitem""",
    "try_cast_tolerant": """
        SELECT p_partkey, try_cast(CASE WHEN p_size % 2 = 0 THEN cast(p_size AS varchar) ELSE p_type END AS int)
               AS as_int FROM part""",
    "rename_projection": """
        SELECT c_custkey AS id_original_cliente, c_name AS nome_cliente, c_acctbal > 5000 AS rico FROM customer""",
    "filter_not_null": """
        SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE nullif(o_orderstatus, 'P') IS NOT NULL""",
    "filter_exclude": "SELECT p_partkey, p_type FROM part WHERE p_type <> 'PROMO'",
    "filter_compare": """
        SELECT o_orderkey, o_orderpriority FROM orders
        WHERE o_orderpriority > '3' AND extract(day FROM o_orderdate) = 1""",
    "norm_trim_upper": """
        SELECT c_custkey, upper(c_name) || ' É' || chr(9) AS name FROM customer""",
    "norm_trim_lower": "SELECT c_custkey, lower(c_name) || '@ex.com' AS email FROM customer",
    "default_null_only": f"SELECT o_orderkey, trim(upper(ifnull(remark, 'não'))) AS remark FROM {_REMARK}",
    "default_blank_only": f"""
        SELECT o_orderkey, CASE WHEN trim(remark) = '' THEN 'não' ELSE trim(upper(remark)) END AS remark
        FROM {_REMARK}""",
    "default_null_or_blank": f"""
        SELECT o_orderkey, CASE WHEN remark IS NULL OR remark = '' THEN 'não' ELSE remark END AS as_is,
               trim(upper(CASE WHEN remark IS NULL OR remark = '' THEN 'não' ELSE remark END)) AS upper
        FROM {_REMARK}""",
    "zero_fill": f"""
        SELECT s_suppkey, cast(ifnull(cast({_BALANCE} AS decimal(10,2)), 0) AS decimal(12,2)) AS as_decimal,
               ifnull({_BALANCE}, 0) AS as_double, ifnull(nullif(s_nationkey, 7), 0) AS as_int
        FROM supplier""",
    "empty_list_default": f"""
        SELECT event_id, CASE event_id % 4 WHEN 2 THEN props ELSE {NI} END AS options FROM events""",
    "state_from_address": f"SELECT unitId, {UF} AS state FROM {_UNITS}",
    "fallback_state": f"SELECT unitId, ifnull(stateId, {UF}) AS state FROM {_UNITS}",
    "postal_code": f"SELECT unitId, {CEP} AS zip FROM {_UNITS}",
    "digits_only": """
        SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits FROM customer""",
    "surrogate_key": f"""
        SELECT o_orderkey, {crc("o_orderkey")} AS sk_order, {crc("o_orderpriority")} AS sk_priority,
               {crc("kept")} AS sk_customer
        FROM (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS kept FROM orders)""",
    "status_decode": f"SELECT o_orderkey, {STATUS_NAME.format('o_orderkey % 9')} AS label FROM orders",
    "platform_decode": """
        SELECT c_custkey, CASE c_custkey % 6 WHEN 1 THEN 'WEB' WHEN 2 THEN 'ANDROID' WHEN 3 THEN 'IOS'
               ELSE 'DESCONHECIDA' END AS label FROM customer""",
    "soft_delete_flag": """
        SELECT o_orderkey, if(o_orderstatus = 'F', 'Inativo', 'Ativo') AS masculine,
               if(o_orderstatus = 'F', 'Inativa', 'Ativa') AS feminine FROM orders""",
    "bool_label": "SELECT o_orderkey, if(o_orderstatus = 'O', 'SIM', 'NÃO') AS label FROM orders",
    "distinct_column": "SELECT DISTINCT o_custkey FROM orders",
    "distinct_rows": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "dedup_any_key": "SELECT DISTINCT user_id FROM events",
    "latest_by_key": newest_sql(
        "SELECT user_id, event_id, ts, event_type, value FROM events", "user_id", ["ts", "event_id"]
    ),
    "latest_with_nulls_and_ties": newest_sql(
        """SELECT nullif(l_suppkey, 3) AS supplier,
                  CASE WHEN l_linenumber <> 2 THEN l_quantity END AS quantity,
                  l_orderkey, l_partkey, l_linenumber FROM lineitem""",
        "supplier",
        ["quantity", "l_orderkey", "l_partkey", "l_linenumber"],
    ),
    "join_inner_using": f"""
        SELECT c_custkey, o_orderkey, c_name
        FROM ({newest_sql("SELECT * FROM orders", "o_custkey", ["o_orderdate", "o_orderkey"])})
        JOIN (SELECT 2 * c_custkey AS c_custkey, c_name FROM customer) ON o_custkey = c_custkey""",
    "join_star_left": f"""
        SELECT o_orderkey, cust, status, o_orderpriority, nation, region,
               {crc("c_custkey")} AS sk_cust, {crc("st")} AS sk_status, {crc("pr")} AS sk_priority,
               {crc("n_nationkey")} AS sk_nation, {crc("r_regionkey")} AS sk_region
        FROM (SELECT o_orderkey, nullif(o_custkey, 7) AS cust, nullif(o_orderstatus, 'P') AS status,
                     o_orderpriority, cast(o_orderkey % 30 AS int) AS nation,
                     cast(o_orderkey % 7 AS int) AS region FROM orders) o
        LEFT JOIN customer ON cust = c_custkey
        LEFT JOIN (SELECT DISTINCT o_orderstatus AS st FROM orders) ON status = st
        LEFT JOIN (SELECT DISTINCT o_orderpriority AS pr FROM orders) ON o.o_orderpriority = pr
        LEFT JOIN nation ON nation = n_nationkey
        LEFT JOIN region ON region = r_regionkey""",
    "join_detail_left": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, supp, {crc("p_partkey")} AS sk_part,
               {crc("s_suppkey")} AS sk_supp, {crc("o_orderkey")} AS sk_order
        FROM (SELECT * REPLACE (if(l_linenumber = 2, -l_orderkey, l_orderkey) AS l_orderkey),
                     CASE WHEN l_linenumber <> 3 THEN l_suppkey END AS supp FROM lineitem)
        LEFT JOIN part ON l_partkey = p_partkey
        LEFT JOIN supplier ON supp = s_suppkey
        LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "fanout_guard": f"""
        SELECT line_id, count(*) AS copies FROM {_LINE_IDS} GROUP BY line_id HAVING count(*) > 1""",
    "surrogate_collisions": f"""
        SELECT surrogate, count(*) AS natural_keys
        FROM (SELECT {crc("line_id")} AS surrogate FROM (SELECT DISTINCT line_id FROM {_LINE_IDS}))
        GROUP BY surrogate HAVING count(*) > 1""",
    "bronze_paged": bronze_sql("evaluations"),
    **{
        f"bronze_paged_{entity}": bronze_sql(entity)
        for entity in ("checklists", "categories", "items", "units", "users", "user_types")
    },
    "bronze_incremental": f"""
        WITH users AS (SELECT *, name LIKE '%Ação ' AS second FROM ({bronze_sql("users")}))
        SELECT * EXCLUDE (second) FROM (
          SELECT * REPLACE (CASE WHEN second AND cast(userId AS bigint) % 7 = 0 THEN NULL ELSE updatedAt END AS updatedAt)
          FROM users)
        WHERE NOT second OR updatedAt IS NULL
           OR cast(updatedAt AS timestamp) > (SELECT max(cast(updatedAt AS timestamp)) FROM users WHERE NOT second)""",
    "bronze_manifest": f"""
        WITH users AS (
          SELECT *, cast(updatedAt AS timestamp) AS dated,
                 CASE WHEN name NOT LIKE '%Ação ' THEN 1 WHEN cast(userId AS bigint) % 2 = 0 THEN 2 ELSE 3 END AS turn
          FROM ({bronze_sql("users")}))
        SELECT userId, name, updatedAt FROM users u
        WHERE turn = 1 OR dated IS NULL OR dated > (SELECT max(dated) FROM users o WHERE o.turn < u.turn)""",
    "bronze_quarantine": """
        SELECT cast(c_custkey AS varchar) AS userTypeId, CASE WHEN c_custkey % 7 = 0 THEN 'rejected' ELSE 'loaded' END AS found,
               count(*) FILTER (c_custkey % 7 = 0) OVER () AS n_rejected
        FROM customer""",
    "page_gaps": """
        SELECT status, before + 1 AS first_missing, page - 1 AS last_missing
        FROM (SELECT status, page, lag(page, 1, 0) OVER (PARTITION BY status ORDER BY page) AS before
              FROM (SELECT DISTINCT o_orderstatus AS status, o_orderkey AS page FROM orders))
        WHERE page - before > 1""",
    "bronze_incremental_results": f"""
        WITH r AS (SELECT resultId, evaluationId, answeredAt FROM ({bronze_sql("evaluations_results")}))
        SELECT * FROM r UNION ALL SELECT * FROM r WHERE answeredAt IS NULL""",
    "bronze_extra_fields": """
        SELECT cast(c_custkey AS varchar) AS userTypeId, c_name AS name,
               '2024-01-01 00:00:00' AS updatedAt, c_mktsegment AS segment FROM customer""",
    "bronze_superseded_countries": "SELECT cast(n_nationkey AS varchar) AS countryId, n_name AS name FROM nation",
    "bronze_superseded_departments": """
        SELECT cast(o_custkey AS varchar) AS departmentId, cast(o_orderdate AS varchar) AS date FROM orders""",
    "bronze_children": bronze_sql("evaluations_results"),
    "bronze_superseded": """
        SELECT cast(o_orderkey AS varchar) AS evaluationId,
               CASE WHEN o_orderstatus <> 'P' THEN cast(o_orderdate AS varchar) END AS date FROM orders""",
    "bronze_stream": bronze_sql("items"),
    **{f"silver_{entity}": silver_sql(entity) for entity in SILVER},
    "silver_incremental": silver_sql("users"),
    **DIMS,
    "fact_applied": APPLIED,
    "fact_incremental": APPLIED,
    "surrogate_key_map": f"""
        WITH k AS (
          SELECT DISTINCT cast(l_orderkey * 10 + l_linenumber AS varchar) AS line, l_linenumber <= 3 AS late FROM lineitem),
        c AS (SELECT line, late, {crc("line")} AS base FROM k)
        SELECT cast(line AS bigint) AS line_id,
               base + 4294967296 * (row_number() OVER (PARTITION BY base ORDER BY late, line) - 1) AS surrogate
        FROM c""",
    "fact_results": RESULTS,
}
