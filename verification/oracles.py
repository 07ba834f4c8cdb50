"""DuckDB SQL for every query, written from the operators' definitions.

Each check is a SELECT over named sub-results; ``_with`` prepends the ones it needs.
"""

from __future__ import annotations

import re


def _ymd(day: str) -> str:
    return f"strftime({day}, '%Y%m%d')"


def _camel(name: str) -> str:
    words = f"list_transform(string_split({name}, ' '), lambda w: upper(w[1]) || lower(w[2:]))"
    return f"array_to_string({words}, '')"


def _date(text: str) -> str:
    return f"CAST(try_strptime({text}, '%Y%m%d') AS DATE)"


def _title(name: str) -> str:
    spaced = f"regexp_replace({name}, '([a-z])([A-Z])', '\\1 \\2', 'g')"
    words = f"list_transform(string_split({spaced}, ' '), lambda w: upper(w[1]) || lower(w[2:]))"
    return f"array_to_string({words}, ' ')"


def _mode(source: str, by: str, column: str, name: str) -> str:
    """Per-group most frequent value, smallest on ties."""
    return f"""
        SELECT {by}, {column} AS {name} FROM (
            SELECT {by}, {column},
                   row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, {column}) AS place
            FROM {source} WHERE {column} IS NOT NULL AND {by} IS NOT NULL GROUP BY {by}, {column})
        WHERE place = 1"""


def _top(source: str, column: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


_SUB_KEPT = (
    "adsh, cik, name, sic, countryba, stprba, cityba, zipba, baph, fye, form, period, fy, fp, "
    "filed, accepted, instance, year, quarter"
)


def _clean_sub(source: str) -> str:
    return f"""
        SELECT adsh, cik, trim(name, ' ') AS name, sic, trim(countryba, ' ') AS countryba,
               trim(stprba, ' ') AS stprba, trim(cityba, ' ') AS cityba, trim(zipba, ' ') AS zipba,
               regexp_replace(baph, '[^0-9]', '', 'g') AS baph, fye, trim(form, ' ') AS form,
               {_date('period')} AS period, fy, fp, {_date('filed')} AS filed,
               CAST(date_diff('day', {_date('period')}, {_date('filed')}) AS INTEGER) AS delay_days,
               accepted, trim(instance, ' ') AS instance
        FROM {source}
        WHERE adsh IS NOT NULL AND cik IS NOT NULL AND name IS NOT NULL AND sic IS NOT NULL"""


def _clean_num(source: str) -> str:
    own = "TRY_CAST(substring(ddate, 1, 4) AS INTEGER) BETWEEN 1997 AND 2000"
    repaired = (
        f"concat_ws('', CASE WHEN {own} THEN substring(ddate, 1, 4) ELSE CAST(year AS VARCHAR) END, "
        "substring(ddate, 5, 2), substring(ddate, 7, 2))"
    )
    return f"""
        SELECT adsh, tag, upper(version) AS version, {_date(repaired)} AS ddate, qtrs, uom, value,
               is_value_incomplete
        FROM {source}
        WHERE value IS NOT NULL AND adsh IS NOT NULL AND tag IS NOT NULL AND version IS NOT NULL
          AND qtrs < 5"""


def _clean_pre(source: str) -> str:
    return f"""
        SELECT trim(adsh, ' ') AS adsh, report, line, trim(stmt, ' ') AS stmt,
               trim(tag, ' ') AS tag, trim(version, ' ') AS version, trim(plabel, ' ') AS plabel
        FROM {source} WHERE stmt IS NOT NULL"""


def _number_tags(source: str) -> str:
    every = ", ".join(
        f"{name} NULLS FIRST"
        for name in "tag version custom abstract datatype iord crdr tlabel doc".split()
    )
    return f"""
        SELECT tag_id, tag, version, datatype, iord, tlabel, doc FROM (
            SELECT row_number() OVER (ORDER BY {every}) AS tag_id, * FROM {source})
        WHERE NOT abstract"""


_COMPANY = "cik, name, sic, countryba, stprba, cityba, zipba, baph, fye, form, fy, fp"

# Named sub-results, in dependency order.
_PARTS: dict[str, str] = {
    "sub_raw": f"""
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS adsh,
               c_custkey AS cik,
               ' ' || c_name || ' ' AS name,
               CASE WHEN o_orderkey % 5 = 0 OR o_custkey % 40 = 0 THEN NULL
                    ELSE CAST(c_nationkey * 100 + o_orderkey % 2 AS INTEGER) END AS sic,
               CASE WHEN o_orderkey % 7 = 0 OR o_custkey % 50 = 0 THEN NULL
                    ELSE ' ' || o_orderpriority END AS countryba,
               ' ' || c_mktsegment AS stprba,
               'City ' || CAST(c_nationkey AS VARCHAR) AS cityba,
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS zipba,
               '(' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') || ') 555-0100' AS baph,
               CASE WHEN o_orderkey % 13 = 0 OR o_custkey % 60 = 0 THEN NULL
                    WHEN o_custkey % 3 = 0 THEN '0630' ELSE '1231' END AS fye,
               ' ' || o_orderstatus || ' ' AS form,
               CASE WHEN o_orderkey % 11 = 0 OR o_custkey % 70 = 0 THEN NULL
                    ELSE {_ymd('o_orderdate')} END AS period,
               CASE WHEN o_orderkey % 401 = 0 THEN 300000
                    WHEN o_orderkey % 17 = 0 OR o_custkey % 80 = 0 THEN NULL
                    ELSE CAST(year(o_orderdate) AS INTEGER) END AS fy,
               CASE WHEN o_orderkey % 19 = 0 OR o_custkey % 90 = 0 THEN NULL
                    ELSE 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) END AS fp,
               {_ymd('(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER))')} AS filed,
               o_orderdate AS accepted,
               ' inst_' || CAST(o_orderkey AS VARCHAR) || ' ' AS instance,
               CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(quarter(o_orderdate) AS INTEGER) AS quarter
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "num_raw": f"""
        SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS adsh,
               {_camel('p_name')} AS tag,
               p_brand AS version,
               CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE {_ymd('l_shipdate')} END AS ddate,
               CAST(l_linenumber - 1 AS INTEGER) AS qtrs,
               CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE l_returnflag END AS uom,
               CASE WHEN (l_orderkey + l_linenumber) % 4 = 0 OR (l_partkey + l_suppkey) % 5 = 0
                      OR (length(p_name) % 3 = 0 AND l_orderkey % 2 = 0)
                    THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(28, 4)) END AS value,
               CAST(2001 - l_orderkey % 3 AS INTEGER) AS year, CAST(1 + l_orderkey % 4 AS INTEGER) AS quarter
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "tag_raw": f"""
        SELECT {_camel('p_name')} AS tag, p_brand AS version,
               CAST(min(p_partkey) % 2 AS INTEGER) AS custom,
               min(p_partkey) % 10 = 0 AS abstract,
               min(p_type) AS datatype,
               CASE WHEN min(p_size) % 2 = 0 THEN 'I' ELSE 'D' END AS iord,
               'C' AS crdr, min(p_name) AS tlabel, max(p_name) AS doc,
               2001 AS year, 1 AS quarter
        FROM part GROUP BY p_name, p_brand""",
    "tag_second": """
        SELECT * REPLACE (
            CASE WHEN length(tag) % 3 = 0 THEN tlabel || ' (new)' ELSE tlabel END AS tlabel,
            2 AS quarter)
        FROM tag_raw""",
    "tag_history": """
        SELECT * FROM tag_raw
        UNION ALL SELECT * FROM tag_second
        UNION ALL SELECT * REPLACE (3 AS quarter) FROM tag_second WHERE length(tag) % 2 = 0""",
    "pre_raw": f"""
        SELECT lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS adsh,
               CAST(min(l_linenumber) AS INTEGER) AS report,
               CAST(min(l_suppkey) % 20 AS INTEGER) AS line,
               CASE WHEN l_orderkey % 6 = 0 OR p_name = 'small ring' THEN NULL
                    WHEN min(l_linestatus) = 'O' THEN ' BS ' ELSE 'IS' END AS stmt,
               {_camel('p_name')} AS tag, p_brand AS version,
               CASE WHEN l_orderkey % 8 = 0 THEN NULL ELSE ' ' || p_name END AS plabel,
               2001 AS year, 1 AS quarter
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY l_orderkey, p_name, p_brand""",
    "num_text": """
        SELECT adsh, tag, version,
               CASE WHEN CAST(adsh AS BIGINT) % 13 = 0 THEN '20240231' ELSE ddate END AS ddate,
               CASE WHEN CAST(adsh AS BIGINT) % 11 = 0 THEN 'n/a' ELSE CAST(qtrs AS VARCHAR) END AS qtrs,
               uom,
               CASE WHEN CAST(adsh AS BIGINT) % 10 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS value,
               year, quarter
        FROM num_raw""",
    # Submissions: group modes, then the most frequent value of the filled column.
    "sic_mode": _mode("sub_raw", "cik", "sic", "found"),
    "country_mode": _mode("sub_raw", "cik", "countryba", "found"),
    "sub_grouped": """
        SELECT s.* REPLACE (coalesce(s.sic, a.found) AS sic, coalesce(s.countryba, b.found) AS countryba)
        FROM sub_raw s LEFT JOIN sic_mode a USING (cik) LEFT JOIN country_mode b USING (cik)""",
    "sub_categories": f"""
        SELECT * REPLACE (
            coalesce(sic, {_top('sub_grouped', 'sic')}) AS sic,
            coalesce(countryba, {_top('sub_grouped', 'countryba')}) AS countryba)
        FROM sub_grouped""",
    "fy_mode": _mode("sub_raw", "cik", "fy", "found"),
    "fp_mode": _mode("sub_raw", "cik", "fp", "found"),
    "sub_medians": """
        SELECT cik, quantile_disc(CAST(period AS INTEGER), 0.5) AS period_found,
               quantile_disc(CAST(fye AS INTEGER), 0.5) AS fye_found
        FROM sub_raw GROUP BY cik""",
    "sub_date_groups": """
        SELECT s.adsh, coalesce(s.fye, lpad(CAST(m.fye_found AS VARCHAR), 4, '0'), '1231') AS fye,
               coalesce(s.fy, a.found, year(strptime(s.filed, '%Y%m%d'))) AS fy,
               coalesce(s.period, lpad(CAST(m.period_found AS VARCHAR), 8, '0')) AS period,
               coalesce(s.fp, b.found, 'FY') AS fp
        FROM sub_raw s LEFT JOIN fy_mode a USING (cik) LEFT JOIN fp_mode b USING (cik)
             LEFT JOIN sub_medians m USING (cik)""",
    "sub_dates": """
        SELECT adsh, fye, CAST(fy AS INTEGER) AS fy, fp,
               coalesce(period, CASE WHEN CAST(fy AS BIGINT) * 10000 + CAST(fye AS INTEGER) < 100000000
                   THEN lpad(CAST(CAST(fy AS BIGINT) * 10000 + CAST(fye AS INTEGER) AS VARCHAR), 8, '0') END) AS period
        FROM sub_date_groups""",
    "sub_imputed": f"""
        SELECT {_SUB_KEPT} FROM (
            SELECT c.* EXCLUDE (fye, fy, fp, period), d.fye, d.fy, d.fp, d.period
            FROM sub_categories c JOIN sub_dates d USING (adsh))""",
    "sub_silver": _clean_sub("sub_imputed"),
    # Numbers: medians per company, tag and unit; a NULL in the group key matches nothing.
    "num_owned": "SELECT n.*, s.cik FROM num_raw n LEFT JOIN sub_raw s USING (adsh)",
    "num_medians": """
        SELECT cik, tag, uom, quantile_disc(value, 0.5) AS found
        FROM num_owned WHERE value IS NOT NULL GROUP BY cik, tag, uom""",
    "num_imputed": """
        SELECT n.adsh, n.tag, n.version, n.ddate, n.qtrs, n.uom,
               coalesce(n.value, m.found) AS value, n.year, n.quarter,
               m.found IS NULL AS is_value_incomplete
        FROM num_owned n LEFT JOIN num_medians m
             ON n.cik = m.cik AND n.tag = m.tag AND n.uom = m.uom""",
    "num_silver": _clean_num("num_imputed"),
    "stmt_mode": _mode("pre_raw", "tag", "stmt", "found"),
    "pre_statements": """
        SELECT p.* REPLACE (coalesce(p.stmt, m.found, 'UN') AS stmt)
        FROM pre_raw p LEFT JOIN stmt_mode m USING (tag)""",
    "pre_imputed": f"""
        SELECT * REPLACE (coalesce(plabel, {_title('tag')}) AS plabel) FROM pre_statements""",
    "pre_silver": _clean_pre("pre_imputed"),
    "tag_upper": "SELECT * REPLACE (upper(version) AS version) FROM tag_raw WHERE version IS NOT NULL",
    "tag_silver": _number_tags("tag_upper"),
    "history_upper": """
        SELECT * REPLACE (upper(version) AS version) FROM tag_history WHERE version IS NOT NULL""",
    "history_latest": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY tag, version ORDER BY year DESC, quarter DESC) AS place
            FROM history_upper)
        WHERE place = 1""",
    "companies": f"""
        SELECT row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in _COMPANY.split(', '))})
               AS id, * FROM (SELECT DISTINCT {_COMPANY} FROM sub_silver)""",
    "dates": """
        SELECT row_number() OVER (ORDER BY ddate) AS id, ddate,
               CAST(year(ddate) AS INTEGER) AS year, CAST(quarter(ddate) AS INTEGER) AS quarter,
               CAST(month(ddate) AS INTEGER) AS month, CAST(day(ddate) AS INTEGER) AS day
        FROM (SELECT DISTINCT ddate FROM num_silver WHERE ddate IS NOT NULL)""",
    "positions": """
        SELECT row_number() OVER (ORDER BY stmt NULLS FIRST, report NULLS FIRST, line NULLS FIRST,
                                           plabel NULLS FIRST) AS id, *
        FROM (SELECT DISTINCT stmt, report, line, plabel FROM pre_silver)""",
    "filing_company": f"""
        SELECT s.adsh, s.cik, c.id AS dim_company_id
        FROM sub_silver s JOIN companies c
          ON {' AND '.join(f's.{c} IS NOT DISTINCT FROM c.{c}' for c in _COMPANY.split(', '))}""",
    "fact": """
        SELECT n.adsh, n.tag, n.version, n.ddate, n.value, f.cik, f.dim_company_id,
               d.id AS dim_date_id, t.tag_id AS dim_tag_id, q.id AS dim_pre_id, n.uom, n.qtrs
        FROM num_silver n
        JOIN tag_silver t ON n.tag = t.tag AND n.version = t.version
        JOIN filing_company f ON n.adsh = f.adsh
        JOIN dates d ON n.ddate = d.ddate
        JOIN pre_silver p ON n.adsh = p.adsh AND n.tag = p.tag AND n.version = upper(p.version)
        JOIN positions q ON p.stmt = q.stmt AND p.report = q.report AND p.line = q.line
                        AND p.plabel = q.plabel""",
}


# The same sub-results of the first of two updates, named ``<name>_one``.
_LATE = {name: "CAST(adsh AS BIGINT) % 6 = 3" for name in ("sub_raw", "num_raw", "pre_raw")}
_PARTS["tag_arrivals"] = """
    SELECT * REPLACE (CASE WHEN length(tag) % 5 = 0 THEN 2 ELSE 1 END AS quarter) FROM tag_raw
    UNION ALL
    SELECT * REPLACE ('again' AS tlabel, 2 AS quarter) FROM tag_raw WHERE length(tag) % 7 = 0 AND length(tag) % 5 <> 0"""


def _renamed(text: str, names: dict[str, str]) -> str:
    return re.sub(r"\b\w+\b", lambda word: names.get(word[0], word[0]), text)


def _kept_keys(columns: str, first: str, second: str, key: str = "id") -> str:
    """Keys given in two updates: those of the first stay, new rows are numbered after them."""
    order = ", ".join(f"{c} NULLS FIRST" for c in columns.split(", "))
    return f"""
        SELECT {key}, {columns} FROM (
            SELECT row_number() OVER (ORDER BY came, {order}) AS {key}, {columns}, last FROM (
                SELECT {columns}, min(run) AS came, max(run) AS last
                FROM (SELECT {columns}, 1 AS run FROM {first} UNION ALL SELECT {columns}, 2 FROM {second})
                GROUP BY {columns}))
        WHERE last = 2"""


_FIRST_UPDATE = [
    name for name in _PARTS if name.split("_")[0] in ("sub", "num", "pre", "stmt", "sic", "country", "fy", "fp") and name != "num_text"
]
for _name in _FIRST_UPDATE:
    _ones = {name: f"{name}_one" for name in _FIRST_UPDATE}
    _PARTS[f"{_name}_one"] = (
        f"SELECT * FROM {_name} WHERE NOT ({_LATE[_name]})" if _name in _LATE else _renamed(_PARTS[_name], _ones)
    )
_PARTS |= {
    "arrivals_latest": """
        SELECT * EXCLUDE (place) FROM (
            SELECT * REPLACE (upper(version) AS version),
                   row_number() OVER (PARTITION BY tag, upper(version) ORDER BY year DESC, quarter DESC) AS place
            FROM tag_arrivals)
        WHERE place = 1""",
    "kept_tag_keys": _kept_keys(
        "tag, version", "(SELECT * REPLACE (upper(version) AS version) FROM tag_arrivals WHERE quarter = 1)", "arrivals_latest", "tag_id"
    ),
    "kept_tags": "SELECT k.tag_id, a.* FROM arrivals_latest a JOIN kept_tag_keys k USING (tag, version) WHERE NOT a.abstract",
    "kept_companies": _kept_keys(_COMPANY, "sub_silver_one", "sub_silver"),
    "kept_dates": _kept_keys(
        "ddate", "(SELECT ddate FROM num_silver_one WHERE ddate IS NOT NULL)", "(SELECT ddate FROM num_silver WHERE ddate IS NOT NULL)"
    ),
    "kept_positions": _kept_keys("stmt, report, line, plabel", "pre_silver_one", "pre_silver"),
}
_KEPT = {"companies": "kept_companies", "dates": "kept_dates", "positions": "kept_positions", "tag_silver": "kept_tags"}
_PARTS["kept_filing_company"] = _renamed(_PARTS["filing_company"], _KEPT)
_PARTS["kept_fact"] = _renamed(_PARTS["fact"], {**_KEPT, "filing_company": "kept_filing_company"})


def _with(select: str) -> str:
    """``select`` with the sub-results it uses, directly or through others."""

    def named_in(text: str) -> set[str]:
        return set(re.findall(r"\b\w+\b", text)) & _PARTS.keys()

    needed: set[str] = set()
    open_names = named_in(select)
    while open_names:
        name = open_names.pop()
        needed.add(name)
        open_names |= named_in(_PARTS[name]) - needed
    parts = [f"{name} AS MATERIALIZED ({_PARTS[name]})" for name in _PARTS if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + select


def _profile(source: str, columns: dict[str, str]) -> str:
    """One SELECT per profiled column; ``columns`` maps names to Spark type names."""
    rows = []
    for name, data_type in columns.items():
        top = "NULL", "NULL", "NULL"
        if data_type == "string":
            best = (
                f"(SELECT {name} AS v, count(*) AS n FROM {source} WHERE {name} IS NOT NULL "
                "GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"
            )
            top = (
                f"(SELECT v FROM {best})",
                f"coalesce((SELECT n FROM {best}), 0)",
                f"coalesce((SELECT n FROM {best}), 0) * 100.0 / count(*)",
            )
        rows.append(f"""
            SELECT '{name}' AS cols, '{data_type}' AS data_types,
                   round(CAST(count(*) - count({name}) AS DOUBLE) * 100.0 / count(*), 6) AS null_percentage,
                   count(DISTINCT {name}) AS distinct_count,
                   CAST({top[0]} AS VARCHAR) AS top1_value, CAST({top[1]} AS BIGINT) AS top1_value_count,
                   round(CAST({top[2]} AS DOUBLE), 6) AS top1_value_percentage
            FROM {source}""")
    return " UNION ALL ".join(rows)


def _texts(names: str) -> dict[str, str]:
    return dict.fromkeys(names.split(), "string")


_NUM_TYPES = {
    **_texts("adsh tag version ddate uom"),
    "qtrs": "int", "value": "decimal(28,4)", "year": "int", "quarter": "int",
}
_SUB_TYPES = {
    **_texts("adsh name countryba stprba cityba zipba baph fye form period fp filed instance"),
    "cik": "bigint", "sic": "int", "fy": "int", "accepted": "timestamp_ntz", "year": "int", "quarter": "int",
}
_TAG_TYPES = {
    **_texts("tag version datatype iord crdr tlabel doc"),
    "custom": "int", "abstract": "boolean", "year": "int", "quarter": "int",
}
_PRE_TYPES = {
    **_texts("adsh stmt tag version plabel"),
    "report": "int", "line": "int", "year": "int", "quarter": "int",
}


def _nulls(source: str, by: str, having: str = "") -> str:
    return f"""
        SELECT {by}, count(*) FILTER (value IS NULL) AS null_count, count(*) AS total_count,
               round(count(*) FILTER (value IS NULL) / count(*) * 100, 2) AS null_pct_of_{by}
        FROM {source} WHERE {by} IS NOT NULL GROUP BY {by}
        HAVING count(*) FILTER (value IS NULL) > 0 {having}
        ORDER BY null_count DESC, {by}"""


def _share(source: str, by: str) -> str:
    return f"""
        SELECT {by}, count(*) AS "count",
               round(count(*) * 100 / (SELECT count(*) FROM {source}), 6) AS percentage
        FROM {source} GROUP BY {by}"""


def _frequency(source: str, by: str) -> str:
    return f'SELECT {by}, count(*) AS "count" FROM {source} GROUP BY {by}'


def _summary(column: str) -> str:
    return f"""
        SELECT '{column}' AS "column", count({column}) AS "count",
               round(avg(CAST({column} AS DOUBLE)), 3) AS mean,
               round(stddev_samp(CAST({column} AS DOUBLE)), 3) AS stddev,
               CAST(min({column}) AS VARCHAR) AS min,
               CAST(quantile_disc({column}, 0.25) AS VARCHAR) AS p25,
               CAST(quantile_disc({column}, 0.5) AS VARCHAR) AS p50,
               CAST(quantile_disc({column}, 0.75) AS VARCHAR) AS p75,
               CAST(max({column}) AS VARCHAR) AS max
        FROM num_raw"""


def _residual(source: str, column: str) -> str:
    return f"SELECT '{column}' AS cols, count(*) - count({column}) AS nulls FROM {source}"


_FACT = "adsh, tag, version, ddate, value, cik, dim_company_id, dim_date_id, dim_tag_id, dim_pre_id"
_PATTERN = r"(?i)(\d{4})[^\d]*q([1-4])"

_CHECKS: dict[str, str] = {
    "conform_numbers": f"""
        SELECT adsh, tag, version, ddate, TRY_CAST(qtrs AS INTEGER) AS qtrs, uom,
               CAST(NULL AS VARCHAR) AS coreg, TRY_CAST(value AS DECIMAL(28, 4)) AS value,
               CAST(NULL AS VARCHAR) AS footnote, year, quarter, {_date('ddate')} AS ddate_parsed
        FROM num_text""",
    "path_year_quarter": f"""
        SELECT o_orderkey, path,
               TRY_CAST(regexp_extract(path, '{_PATTERN}', 1) AS INTEGER) AS year,
               TRY_CAST(regexp_extract(path, '{_PATTERN}', 2) AS INTEGER) AS quarter
        FROM (SELECT o_orderkey, '/lake/' || CASE o_orderkey % 9
                         WHEN 0 THEN year(o_orderdate)::VARCHAR
                         WHEN 1 THEN year(o_orderdate)::VARCHAR || '-01q' || quarter(o_orderdate)::VARCHAR
                         WHEN 2 THEN 'FS_' || year(o_orderdate)::VARCHAR || '_Q' || quarter(o_orderdate)::VARCHAR
                         WHEN 3 THEN year(o_orderdate)::VARCHAR || 'q7'
                         ELSE year(o_orderdate)::VARCHAR || 'q' || quarter(o_orderdate)::VARCHAR
                     END || '/num.parquet' AS path
              FROM orders)""",
    "bronze_roundtrip": "SELECT * FROM sub_raw",
    "load_checks": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(*) AS rows, count(*) - count({value}) AS nulls,
                   count(*) FILTER ({source} IS NOT NULL AND {value} IS NULL) AS failures FROM num_text"""
        for name, source, value in [(n, n, n) for n in ("adsh", "tag", "version", "ddate", "uom")]
        + [("qtrs", "qtrs", "TRY_CAST(qtrs AS INTEGER)"), ("value", "value", "TRY_CAST(value AS DECIMAL(28, 4))")]
        + [(n, "NULL", "NULL") for n in ("coreg", "footnote")]
    ),
    "quarantined_numbers": """
        SELECT adsh, tag, version, year, quarter, 'qtrs' AS "column", qtrs AS value FROM num_text
        WHERE qtrs IS NOT NULL AND TRY_CAST(qtrs AS INTEGER) IS NULL
        UNION ALL
        SELECT adsh, tag, version, year, quarter, 'value', value FROM num_text
        WHERE value IS NOT NULL AND TRY_CAST(value AS DECIMAL(28, 4)) IS NULL""",
    "types_over_quarters": """
        SELECT adsh, tag, value, year, quarter, CASE WHEN year < 2001 THEN CAST(adsh AS BIGINT) END AS filing FROM num_raw""",
    "sub_mode_impute": "SELECT adsh, cik, sic, countryba FROM sub_categories",
    "sub_date_impute": """
        SELECT d.adsh, s.cik, d.fye, d.period, d.fy, d.fp, s.filed
        FROM sub_dates d JOIN sub_raw s USING (adsh)""",
    "sub_clean": _clean_sub("sub_raw"),
    "num_median_impute": "SELECT * FROM num_imputed",
    "num_median_impute_exact": "SELECT * FROM num_imputed",
    "num_median_large_groups": """
        SELECT adsh, 'all' AS tag, version, ddate, qtrs, CASE WHEN uom IS NOT NULL THEN 'all' END AS uom,
               coalesce(value, CASE WHEN uom IS NOT NULL THEN found END) AS value, year, quarter,
               uom IS NULL OR cik IS NULL OR found IS NULL AS is_value_incomplete
        FROM num_owned LEFT JOIN (
            SELECT cik % 2 AS half, quantile_disc(value, 0.5) AS found
            FROM num_owned WHERE value IS NOT NULL AND uom IS NOT NULL AND cik IS NOT NULL GROUP BY cik % 2)
          ON cik % 2 = half""",
    "num_clean": _clean_num("(SELECT *, uom IS NULL AS is_value_incomplete FROM num_raw)"),
    "pre_stmt_impute": "SELECT * FROM pre_statements",
    "pre_label_impute": f"SELECT * REPLACE (coalesce(plabel, {_title('tag')}) AS plabel) FROM pre_raw",
    "pre_clean": _clean_pre("pre_raw"),
    "tag_clean": _number_tags("history_latest"),
    "tag_clean_all_quarters": _number_tags("history_upper"),
    "impute_residuals": " UNION ALL ".join(
        [_residual("sub_imputed", c) for c in ("sic", "countryba", "fye", "fy", "period", "fp")]
        + [_residual("pre_imputed", c) for c in ("stmt", "plabel")]
    ),
    "numbers_in_two_updates": "SELECT * FROM num_silver",
    "companies_in_two_updates": "SELECT * FROM kept_companies",
    "fact_in_two_updates": f"SELECT {_FACT} FROM kept_fact",
    "dim_tag": "SELECT * FROM tag_silver",
    "dim_submission": """
        SELECT adsh, form, period, filed, delay_days, accepted, instance FROM sub_silver""",
    "dim_company": "SELECT * FROM companies",
    "dim_date": "SELECT * FROM dates",
    "dim_pre": "SELECT * FROM positions",
    "fact_financial": f"SELECT {_FACT} FROM fact",
    "layers_in_two_runs": f"SELECT {_FACT} FROM fact",
    "fact_from_buckets": f"SELECT {_FACT} FROM fact",
    "fact_with_units": f"SELECT {_FACT}, uom, qtrs FROM fact",
    "profile_numbers": _profile("num_raw", _NUM_TYPES),
    "profile_submissions": _profile("sub_raw", _SUB_TYPES),
    "profile_tags": _profile("tag_raw", _TAG_TYPES),
    "profile_presentations": _profile("pre_raw", _PRE_TYPES),
    "profile_flags": f"""
        SELECT cols, null_percentage > 50 AS drop_candidate,
               data_types = 'string' AND distinct_count < 50 AS dimension_candidate,
               coalesce(top1_value_percentage > 90, false) AS dominant_value
        FROM ({_profile('pre_raw', _PRE_TYPES)})""",
    "nulls_by_tag": _nulls("num_raw", "tag"),
    "nulls_by_tag_ge50": _nulls(
        "num_raw",
        "tag",
        "AND round(count(*) FILTER (value IS NULL) / count(*) * 100, 2) >= 50",
    ),
    "nulls_by_uom": _nulls("num_raw", "uom"),
    "nulls_by_qtrs": _nulls("num_raw", "qtrs"),
    "uom_share": _share("num_raw", "uom"),
    "tag_custom_share": _share("tag_raw", "custom"),
    "custom_usage": """
        SELECT custom, count(*) AS "count", round(count(*) * 100 / sum(count(*)) OVER (), 6) AS percentage
        FROM num_raw LEFT JOIN tag_raw USING (tag, version) GROUP BY custom""",
    "qtrs_freq": _frequency("num_raw", "qtrs"),
    "datatype_freq": _frequency("tag_raw", "datatype"),
    "value_summary": f"{_summary('value')} UNION ALL {_summary('qtrs')}",
    "filing_lookup_stored": "SELECT * FROM num_raw WHERE adsh = '0000000007'",
    "profile_by_quarter": " UNION ALL ".join(
        f"""SELECT '{name}' AS cols, '{kind}' AS data_types, count(*) AS rows,
                   round((count(*) - count({name})) * 100.0 / count(*), 6) AS null_percentage, true AS distinct_close,
                   {f"(SELECT v FROM {best})" if name in ("uom", "version") else "CAST(NULL AS VARCHAR)"} AS top1_value,
                   {f"(SELECT n FROM {best})" if name in ("uom", "version") else "CAST(NULL AS BIGINT)"} AS top1_value_count,
                   {", ".join(f"CAST({value} AS DOUBLE) AS {column}" for column, value in found.items())}
            FROM num_raw"""
        for name, kind in _NUM_TYPES.items()
        if name not in ("year", "quarter")
        for best in [f"(SELECT {name} AS v, count(*) AS n FROM num_raw WHERE {name} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)"]
        for found in [
            dict.fromkeys(("low", "high", "mean", "stddev"), "NULL") if kind == "string" else
            {"low": f"min({name})", "high": f"max({name})", "mean": f"round(avg(CAST({name} AS DOUBLE)), 3)",
             "stddev": f"round(stddev_samp(CAST({name} AS DOUBLE)), 3)"}
        ]
    ),
    "filing_lookup": "SELECT * FROM num_raw WHERE adsh = '0000000007'",
    "non_monetary_tags": "SELECT * FROM tag_raw WHERE datatype <> 'ECONOMY'",
    "distinct_forms": "SELECT DISTINCT form FROM sub_raw",
    "top_tags": """
        SELECT tag, count(*) AS "count" FROM num_raw WHERE tag IS NOT NULL
        GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 20""",
    "uom_filter": "SELECT * FROM num_raw WHERE uom = 'R'",
    "quarter_end_dates": f"""
        SELECT * FROM (SELECT * REPLACE ({_date('ddate')} AS ddate) FROM num_raw)
        WHERE month(ddate) % 3 = 0 AND ddate = last_day(ddate)""",
    "value_parse": """
        SELECT adsh, tag, value_text,
               TRY_CAST(regexp_replace(value_text, '[^0-9.-]', '', 'g') AS DECIMAL(28, 4)) AS value
        FROM (SELECT adsh, tag, CASE CAST(adsh AS BIGINT) % 10
                         WHEN 0 THEN 'NM' WHEN 1 THEN '$ ' || CAST(value AS VARCHAR)
                         WHEN 2 THEN 'USD -' || CAST(value AS VARCHAR) WHEN 3 THEN '—'
                         ELSE CAST(value AS VARCHAR) END AS value_text
              FROM num_raw)""",
    "tsv_roundtrip": "SELECT * FROM num_raw",
    "overwrite_roundtrip": "SELECT * FROM tag_silver",
}

ORACLES: dict[str, str] = {name: _with(select) for name, select in _CHECKS.items()}
