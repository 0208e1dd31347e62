"""SQL texts for the oracle: the same questions asked in plain SQL."""

from __future__ import annotations

from annalist.plans.inputs import Feed
from annalist.plans.registry import TEST_SALT
from annalist.spec import EntitySpec


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def snapshot(name: str, feed: Feed, spec: EntitySpec) -> str:
    order = ", ".join(f"{c[1:]} DESC" if c.startswith("-") else c for c in spec.tie_break)
    return (
        f"{name}_raw AS ({feed.sql()}),\n"
        f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY"
        f" {spec.key}, {spec.date} ORDER BY {order}) AS rn FROM {name}_raw) WHERE rn = 1)"
    )


def digest(spec: EntitySpec) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in spec.tracked]
    if spec.missing is not None:
        texts = [f"coalesce({t}, '{spec.missing}')" for t in texts]
    return f"sha256(concat_ws('|', {', '.join(texts)}))"


def events(name: str, source: str, spec: EntitySpec) -> str:
    """Change events ``name`` with prev_x, x pairs, tracked_hash and is_initial."""
    k, d, t = spec.key, spec.date, spec.tracked
    prev = ", ".join(f"lag({c}) OVER w AS prev_{c}" for c in t)
    pairs = ", ".join(f"prev_{c}, {c}" for c in t)
    return (
        f"{name}_l AS (SELECT *, {digest(spec)} AS tracked_hash, lag({digest(spec)}) OVER w AS ph,"
        f" row_number() OVER w AS pos, {prev} FROM {source}"
        f" WINDOW w AS (PARTITION BY {k} ORDER BY {d})),\n"
        f"{name} AS (SELECT {k}, {d} AS event_date, {pairs}, tracked_hash, pos = 1 AS is_initial"
        f" FROM {name}_l WHERE pos = 1 OR tracked_hash <> ph)"
    )


def versions(name: str, source: str, spec: EntitySpec) -> str:
    """Type-2 history ``name`` by running version numbers over every snapshot row."""
    k, d, t = spec.key, spec.date, spec.tracked
    if spec.null_safe:
        moved = " OR ".join(f"{c} IS DISTINCT FROM p_{c}" for c in t)
        prev = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in t)
    else:
        moved, prev = "h <> ph", f"lag({digest(spec)}) OVER w AS ph"
    values = ", ".join(
        f"first({c} ORDER BY {d})" + ("" if spec.null_safe else f" FILTER (WHERE {c} IS NOT NULL)")
        + f" AS {c}"
        for c in t
    )
    cols = ", ".join(t)
    return (
        f"{name}_l AS (SELECT {k}, {d}, {cols}, {digest(spec)} AS h, {prev}, row_number() OVER w"
        f" AS pos FROM {source} WINDOW w AS (PARTITION BY {k} ORDER BY {d})),\n"
        f"{name}_n AS (SELECT *, sum(CASE WHEN pos = 1 OR {moved} THEN 1 ELSE 0 END) OVER"
        f" (PARTITION BY {k} ORDER BY {d} ROWS UNBOUNDED PRECEDING) AS ver FROM {name}_l),\n"
        f"{name}_v AS (SELECT {k}, ver, min({d}) AS effective_start_date, max({d}) AS"
        f" last_seen_date, first(h ORDER BY {d}) AS hash_diff, {values} FROM {name}_n"
        f" GROUP BY {k}, ver),\n"
        f"{name} AS (SELECT {k}, effective_start_date, CAST(coalesce(lead(effective_start_date)"
        f" OVER w - 1, DATE '9999-12-31') AS DATE) AS effective_end_date,"
        f" lead(effective_start_date) OVER w IS NULL AS is_current, hash_diff, {cols},"
        f" last_seen_date FROM {name}_v"
        f" WINDOW w AS (PARTITION BY {k} ORDER BY effective_start_date))"
    )


def version_columns(spec: EntitySpec, last_seen: bool = False, digest_column: bool = True) -> str:
    cols = [spec.key, "effective_start_date", "effective_end_date", "is_current"]
    cols += ["hash_diff"] if digest_column else []
    return ", ".join([*cols, *spec.tracked, *(["last_seen_date"] if last_seen else [])])


def date_key(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INT)"


# Masks.


def email(x: str, strict: bool = False) -> str:
    local = f"regexp_replace(string_split({x}, '@')[1], '[^a-zA-Z0-9]', '', 'g')"
    if strict:
        return (
            f"CASE WHEN contains({x}, '@') THEN left({local}, 1) || '***' || CASE WHEN"
            f" length({local}) > 2 THEN right({local}, 1) ELSE '' END || '@' ||"
            f" substr({x}, strpos({x}, '@') + 1) ELSE 'REDACTED_EMAIL' END"
        )
    return (
        f"CASE WHEN {x} IS NULL OR trim({x}, ' ') = '' THEN 'REDACTED_EMAIL' ELSE left({local}, 1)"
        f" || '***' || right({local}, 1) || '@' || string_split({x}, '@')[2] END"
    )


def phone(x: str) -> str:
    digits = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return (
        f"CASE WHEN length({digits}) >= 4 THEN CASE WHEN regexp_replace({x}, '[^0-9+]', '', 'g')"
        f" LIKE '+%' THEN '+' ELSE '' END || '******-' || right({digits}, 4)"
        " ELSE 'REDACTED_PHONE' END"
    )


def postal(x: str) -> str:
    packed = f"replace({x}, ' ', '')"
    return (
        f"CASE WHEN length({x}) > 0 THEN '***' || CASE WHEN length({packed}) >= 3 THEN"
        f" right({packed}, 3) ELSE right({packed}, 1) END ELSE 'REDACTED_POSTAL' END"
    )


def name(x: str) -> str:
    clean = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    words = f"regexp_split_to_array({clean}, '\\s+')"
    return (
        f"CASE WHEN length({clean}) > 0 THEN upper(left({words}[1], 1)) || '*** ' ||"
        f" upper(left({words}[-1], 1)) || '.' ELSE 'REDACTED_NAME' END"
    )


def birth_year(x: str, strict: bool = False) -> str:
    if strict:
        return f"coalesce(split_part(CAST({x} AS VARCHAR), '-', 1), 'REDACTED_BIRTHYEAR')"
    return f"CAST(year({x}) AS VARCHAR)"


def last4(x: str, strict: bool = False) -> str:
    if strict:
        return f"CASE WHEN length({x}) >= 4 THEN right({x}, 4) ELSE '' END"
    return f"coalesce(right({x}, 4), '')"


def token(x: str) -> str:
    return f"sha256('{TEST_SALT}|' || coalesce({x}, ''))"
