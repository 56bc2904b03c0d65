"""Synthetic inputs keyed by rows of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditlark.catalog.registry import quoted, query, sql_between, sql_pick, sql_uniform, table
from auditlark.operators import sla
from auditlark.operators import synth as S

K = "c_custkey"


def sql_padded(value: str, width: int) -> str:
    digits = f"CAST({value} AS VARCHAR)"
    return f"lpad({digits}, greatest(length({digits}), {width})::INTEGER, '0')"


def sql_customers(more: str = "") -> str:
    pad = sql_padded
    first, last = sql_pick(K, "first", S.FIRST_NAMES), sql_pick(K, "last", S.LAST_NAMES)
    finding = f"CASE WHEN {sql_uniform(K, 'has_finding')} % 100 < 60 THEN {sql_pick(K, 'finding', S.FINDINGS)} ELSE '' END"
    return f"""SELECT {more}'C' || {pad(K, 6)} AS customer_id, {first} AS first_name, {last} AS last_name,
lower({first}) || '.' || lower({last}) || {K} || '@example.com' AS email,
concat_ws('-', {sql_pick(K, 'area', S.AREA_CODES)}, {pad(sql_between(K, 'p1', 200, 999), 3)}, {pad(sql_between(K, 'p2', 0, 9999), 4)}) AS phone,
concat_ws('-', {pad(sql_between(K, 's1', 100, 899), 3)}, {pad(sql_between(K, 's2', 1, 99), 2)}, {pad(sql_between(K, 's3', 1, 9999), 4)}) AS ssn,
{sql_between(K, 'house', 1, 9999)} || ' ' || {sql_pick(K, 'street', S.STREETS)} AS address,
{sql_pick(K, 'place', S.PLACES)} AS city, 'CT' AS state, {pad(sql_between(K, 'zip', 1, 99999), 5)} AS zip,
strftime(DATE '1940-01-01' + {sql_between(K, 'born', 0, 23000)}::INTEGER, '%m/%d/%Y') AS date_of_birth, {finding} AS diagnosis,
CASE WHEN {finding} <> '' THEN {sql_pick(K, 'care', S.CARE)} ELSE '' END AS treatment_plan,
CASE WHEN {sql_uniform(K, 'has_origin')} % 100 < 30 THEN {sql_pick(K, 'origin', S.ORIGINS)} ELSE '' END AS racial_ethnic_origin,
CASE WHEN {sql_uniform(K, 'has_faith')} % 100 < 20 THEN {sql_pick(K, 'faith', S.FAITHS)} ELSE '' END AS religion,
{sql_pick(K, 'notes', S.NOTES)} AS notes, CASE WHEN {sql_uniform(K, 'active')} % 100 < 80 THEN 'Active' ELSE 'Inactive' END AS account_status FROM customer"""


def _customers(spark, folder):
    return S.customers(table(spark, folder, "customer", [K], heavy=True), K)


@query("G1 K3", sql_customers())
def generated_customers(spark, folder):
    return _customers(spark, folder)


def sql_requests(key: str, relation: str, more: str = "") -> str:
    return f"""SELECT {more} 'R' || {sql_padded(key, 4)} AS request_id, {key},
'C' || {sql_padded(sql_between(key, 'customer', 1, 1000), 6)} AS customer_id, {sql_pick(key, 'kind', S.REQUEST_TYPES)} AS request_type,
DATE '2024-01-01' + {sql_between(key, 'asked', 0, 364)}::INTEGER AS request_date,
CASE WHEN {sql_between(key, 'roll', 0, 99)} < 5 THEN {sql_between(key, 'very_late', 91, 150)}
     WHEN {sql_between(key, 'roll', 0, 99)} < 20 THEN {sql_between(key, 'late', 46, 90)} ELSE {sql_between(key, 'on_time', 1, 44)} END AS days,
CASE WHEN {sql_uniform(key, 'pending')} % 100 < 10 THEN 'pending' ELSE 'completed' END AS status FROM {relation}"""


SQL_REQUESTS = sql_requests("o_orderkey", "orders")


@query("G2 K3", f"SELECT request_id, customer_id, request_type, strftime(request_date, '%Y-%m-%d') AS request_date, strftime(request_date + days::INTEGER, '%Y-%m-%d') AS response_date, status FROM ({SQL_REQUESTS})")
def generated_requests(spark, folder):
    log = S.request_log(table(spark, folder, "orders", ["o_orderkey"], heavy=True), 1000, "o_orderkey")
    return log.withColumns({c: F.col(c).cast("string") for c in ("request_date", "response_date")})


@query("G2 A8", f"SELECT status, CASE WHEN days > 90 THEN 'very_late' WHEN days > 45 THEN 'late' ELSE 'on_time' END AS bucket, count(*) AS n_requests FROM ({SQL_REQUESTS}) GROUP BY ALL")
def generated_request_buckets(spark, folder):
    log = S.request_log(table(spark, folder, "orders", ["o_orderkey"], heavy=True), 1000, "o_orderkey")
    return sla.sla_buckets(log, ["status"])


def sql_policies(key: str = "user_id", relation: str = "events") -> str:
    held = {r: f"{sql_uniform(key, f'clause_{r}')} % 100 < 50" for r, _ in S.CLAUSES}
    clauses = ", ".join(f"CASE WHEN {held[r]} THEN {quoted(c)} END" for r, c in S.CLAUSES)
    rights = ", ".join(f"CASE WHEN {held[r]} THEN {quoted(r)} END" for r, _ in S.CLAUSES)
    return f"""SELECT {key} AS entity_id, concat_ws(chr(10) || chr(10), {quoted(S.POLICY_HEAD)}, {clauses}, {quoted(S.POLICY_TAIL)}) AS text,
concat_ws(',', {rights}) AS covered_rights FROM (SELECT DISTINCT {key} FROM {relation})"""


@query("G3", sql_policies())
def generated_policies(spark, folder):
    users = table(spark, folder, "events", ["user_id"]).distinct()
    return S.policies(users, "user_id").withColumn("covered_rights", F.array_join("covered_rights", ","))


def _sql_labelled() -> str:
    k = "o_orderkey"
    pick = lambda salt, values: sql_pick(k, salt, values)
    number = lambda salt, low, high: f"{sql_between(k, salt, low, high)}::VARCHAR"
    texts = {
        "email": f"'write to ' || lower({pick('n', S.FIRST_NAMES)}) || {number('e', 1, 9999)} || '@example.org before Friday'",
        "ssn": f"'filed under ' || concat_ws('-', {number('s1', 100, 999)}, {number('s2', 10, 99)}, {number('s3', 1000, 9999)}) || ' at the pension office'",
        "phone": f"'ring ' || concat_ws('-', {number('p1', 200, 999)}, {number('p2', 200, 999)}, {number('p3', 1000, 9999)}) || ' after lunch'",
        "name": f"'the parcel is for ' || {pick('f', S.FIRST_NAMES)} || ' ' || {pick('l', S.LAST_NAMES)} || ' in person'",
        "address": f"'deliver to ' || {number('h', 1, 9999)} || ' ' || {pick('s', S.STREETS)} || ', ' || {pick('t', S.PLACES)}",
    } | {name: pick(name, sentences) for name, sentences in S.SENTENCES.items()}
    label = "[" + ", ".join(quoted(c) for c in S.CLASSES) + f"][1 + {k} % {len(S.CLASSES)}]"
    return (f"SELECT {k} AS id, {label} AS label, CASE {label} " + " ".join(f"WHEN {quoted(c)} THEN {t}" for c, t in texts.items())
            + " END AS text FROM orders")


@query("M6", _sql_labelled())
def generated_labelled_texts(spark, folder):
    return S.labelled_texts(table(spark, folder, "orders", ["o_orderkey"], heavy=True), "o_orderkey")
