"""Verdicts on all page addresses."""

from __future__ import annotations

from tillwright.llm.common import table
from tillwright.llm.registry import query
from tillwright.llm.url_filter import BEGIN, BLOCK, CHARACTERS, END, HELD_OUT, LOWER, ORDER, RULES, UPPER, filter_urls

_TAIL = range(1, ORDER + 2)


def _rules() -> str:
    return ", ".join(f"('{r.pattern}', '{r.host}', '{r.path}', '{r.verdict}')" for r in RULES)


def _probability(c: str) -> str:
    """The interpolated probability of a gram's last character, from the shortest context on."""
    p = f"(1.0::DOUBLE / {CHARACTERS})"
    for n in _TAIL:
        p = (f"CASE WHEN coalesce(c{n}.n_{c}, 0) > 0 THEN (coalesce(g{n}.{c}, 0)::DOUBLE + c{n}.kinds_{c} * {p}) "
             f"/ (c{n}.n_{c} + c{n}.kinds_{c}) ELSE {p} END")
    return p


URL_SQL = rf"""
    WITH cut AS (
        SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    located AS (
        SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
               regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    rules(rule, rule_host, rule_path, verdict) AS (VALUES {_rules()}),
    fitting AS (
        SELECT rid, rule, verdict FROM located JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, rule) = 1),
    ruled AS MATERIALIZED (
        SELECT page_id, host, path, rule, verdict,
               regexp_replace(regexp_replace(translate(host || path, '{UPPER}', '{LOWER}'), '[0-9]+', '0', 'g'), '[^{LOWER}0./_~%=&+:-]', '?', 'g') AS address
        FROM located LEFT JOIN fitting USING (rid)),
    addresses AS MATERIALIZED (
        SELECT address, count_if(verdict = 'allow') AS accepted, count_if(verdict = 'block') AS rejected,
               count_if(verdict IS NULL) AS open, substr(md5(address), 1, 2) < '{HELD_OUT}' AS held
        FROM ruled GROUP BY address),
    grams AS MATERIALIZED (
        SELECT *, unnest(list_transform(range(1, length(address) + 2), lambda i:
            substr('{BEGIN * ORDER}' || address || '{END}', i, {ORDER + 1}))) AS gram FROM addresses),
    counts AS MATERIALIZED (
        SELECT right(gram, size) AS gram, sum(accepted) AS accepted, sum(rejected) AS rejected
        FROM grams, (VALUES {', '.join(f'({n})' for n in _TAIL)}) s(size)
        WHERE accepted + rejected > 0 AND NOT held GROUP BY 1),
    contexts AS MATERIALIZED (
        SELECT left(gram, length(gram) - 1) AS context, sum(accepted) AS n_accepted, sum(rejected) AS n_rejected,
               count_if(accepted > 0) AS kinds_accepted, count_if(rejected > 0) AS kinds_rejected
        FROM counts GROUP BY 1),
    weights AS MATERIALIZED (
        SELECT w.gram, round((ln({_probability('rejected')}) - ln({_probability('accepted')})) * 1e6)::BIGINT AS weight
        FROM (SELECT DISTINCT gram FROM grams WHERE open > 0 OR held) w
        {' '.join(f'LEFT JOIN counts g{n} ON g{n}.gram = right(w.gram, {n})' for n in _TAIL)}
        {' '.join(f"LEFT JOIN contexts c{n} ON c{n}.context = left(right(w.gram, {n}), {n - 1})" for n in _TAIL)}),
    known AS (
        SELECT coalesce(sum(accepted) > 0 AND sum(rejected) > 0, false) AS ok FROM addresses WHERE NOT held),
    scored AS MATERIALIZED (
        SELECT address, any_value(accepted) AS accepted, any_value(rejected) AS rejected, any_value(held) AS held,
               CASE WHEN (SELECT ok FROM known) AND address <> '' THEN sum(weight)::DOUBLE / count(*) / 1e6 END AS score
        FROM grams JOIN weights USING (gram) WHERE open > 0 OR held GROUP BY address),
    sums AS (
        SELECT sum(accepted) AS na, sum(rejected) AS nr, sum(accepted * score) AS sa, sum(rejected * score) AS sr,
               sum(accepted * score * score) AS qa, sum(rejected * score * score) AS qr FROM scored WHERE held AND score IS NOT NULL),
    means AS (SELECT *, sa / na AS ma, sr / nr AS mr FROM sums WHERE na > 0 AND nr > 0),
    curves AS (SELECT *, greatest((qa - sa * ma + qr - sr * mr) / (na + nr), 1e-4) AS v FROM means WHERE mr > ma),
    fitted AS (
        SELECT coalesce(max((mr - ma) / v), 1.0) AS slope, coalesce(max((ma * ma - mr * mr) / (2 * v) + ln(nr / na)), 0.0) AS shift
        FROM curves)
    SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN slope * score + shift > 0 THEN '{BLOCK}' ELSE 'allow' END) AS verdict
    FROM ruled LEFT JOIN scored USING (address) CROSS JOIN fitted"""


@query("op13_url_filters", URL_SQL)
def url_filters(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
