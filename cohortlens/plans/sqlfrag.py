"""DuckDB SQL fragments mirroring the scalar parsers (oracle side only)."""

from __future__ import annotations

from ..functions.parse import (GAMING_MARK, MISSING_TOKENS, MISSING_WAVE, NIGHT_BEFORE_HOUR,
                               NIGHT_FROM_HOUR, NUMBER_RE, ORDINAL_SCORES)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sn(x: str) -> str:
    """Strict numeric parse."""
    v = f"TRY_CAST(NULLIF(regexp_extract(CAST({x} AS VARCHAR), {q(NUMBER_RE)}, 1), '') AS DOUBLE)"
    return f"(CASE WHEN isfinite({v}) THEN {v} END)"


def sv(x: str) -> str:
    """Survey value parse: missing tokens, ordinal words, strict numeric."""
    toks = ", ".join(q(t) for t in MISSING_TOKENS)
    words = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in ORDINAL_SCORES.items())
    norm = f"lower(trim(CAST({x} AS VARCHAR), ' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)))"
    return (f"(CASE WHEN {x} IS NULL OR CAST({x} AS VARCHAR) IN ({toks}) THEN CAST(NULL AS DOUBLE) "
            f"ELSE COALESCE(CASE {norm} {words} END, {sn(x)}) END)")


def flag(x: str) -> str:
    return f"COALESCE(CAST({x} AS VARCHAR) IN ('1', 'TRUE'), false)"


def hour(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(CAST({x} AS VARCHAR), 'T([0-9]{{2}}):', 1), '') AS INTEGER)"


def noct_h(h: str) -> str:
    return f"COALESCE(({h}) < {NIGHT_BEFORE_HOUR} OR ({h}) >= {NIGHT_FROM_HOUR}, false)"


def noct(x: str) -> str:
    return noct_h(hour(x))


def wave(x: str) -> str:
    lead = f"TRY_CAST(NULLIF(regexp_extract(CAST({x} AS VARCHAR), '^\\s*([+-]?[0-9]+)', 1), '') AS INTEGER)"
    return f"COALESCE(NULLIF({lead}, 0), {MISSING_WAVE})"


def gaming(x: str) -> str:
    return f"COALESCE(contains(lower(CAST({x} AS VARCHAR)), {q(GAMING_MARK)}), false)"


def dtext(x: str) -> str:
    """Distinct-count argument that keeps NULL as ''."""
    return f"COALESCE(CAST({x} AS VARCHAR), '')"


def missing(x: str) -> str:
    return f"({x} IS NULL OR CAST({x} AS VARCHAR) = '')"


def rnd(x: str, d: int = 6) -> str:
    """Half-up rounding with the same float operations as the Spark side."""
    scale = float(10 ** d)
    return f"(floor(({x}) * {scale!r} + 0.5) / {scale!r})"


def cif(cond: str) -> str:
    """count_if as BIGINT (DuckDB returns HUGEINT)."""
    return f"CAST(count_if({cond}) AS BIGINT)"
