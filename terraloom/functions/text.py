"""Columns of the generation steps: names, seeds, retries, identifiers, response and path rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraloom.functions.features import hex_number

#: What marks an error as worth another attempt.
RETRY_STATUS = (429, 500, 502, 503, 504)
SAFE_NAMES = {"run": r"^[a-zA-Z0-9][a-zA-Z0-9_-]{0,127}$", "region": r"^[a-z0-9][a-z0-9_-]{0,63}$", "layer": r"^[a-zA-Z0-9._-]+$"}
INT31 = 0x7FFFFFFF


def slug(prompt: Column, most: int = 40) -> Column:
    """Lower case, other characters folded to single dashes, cut after trimming; ``image`` if nothing is left."""
    dashed = F.regexp_replace(F.lower(prompt), "[^a-z0-9]+", "-")
    cut = F.substring(F.regexp_replace(dashed, "^-+|-+$", ""), 1, most)
    return F.when(cut == "", "image").otherwise(cut)


def tile_seed(base: Column, x: Column, y: Column, variant: Column) -> Column:
    key = F.concat_ws(":", *[c.cast("string") for c in (base, x, y, variant)])
    return hex_number(F.substring(F.sha2(key, 256), 1, 8)).bitwiseAND(F.lit(INT31))


def masked_seed(number: Column) -> Column:
    return F.floor(number).cast("bigint").bitwiseAND(F.lit(INT31))


#: What the message of a failure that may pass contains.
RETRY_TOKENS = ("429", "rate", "resource exhausted", "unavailable", "internal", "server error", "timeout", "temporar", "502", "503", "504")


def retryable(status: Column, message: Column, tokens: tuple[str, ...] = RETRY_TOKENS) -> Column:
    """A status to retry, or a message that holds one of the tokens in any case."""
    low = F.lower(message)
    told = F.lit(False)
    for token in tokens:
        told = told | low.contains(token)
    return F.coalesce(status.isin(*RETRY_STATUS), F.lit(False)) | F.coalesce(told, F.lit(False))


def backoff(attempt: Column, base: float, cap: float, jitter: Column | float = 0.0) -> Column:
    """Seconds before the next attempt: doubling, capped, and a jitter on top."""
    jitter = jitter if isinstance(jitter, Column) else F.lit(float(jitter))
    return F.least(F.lit(float(base)) * F.pow(F.lit(2.0), attempt), F.lit(float(max(base, cap)))) + jitter


def image_name(prompt_no: Column, name: Column, variant: Column, candidate: Column, extension: Column) -> Column:
    number = lambda c, n: F.lpad(c.cast("string"), F.greatest(F.lit(n), F.length(c.cast("string"))), "0")  # noqa: E731  (a bare lpad cuts longer numbers)
    return F.concat(number(prompt_no, 4), F.lit("-"), name, F.lit("-v"), number(variant, 2), F.lit("-c"), number(candidate, 2), F.lit("."), extension)


def extension(mime: Column) -> Column:
    low = F.lower(F.coalesce(mime, F.lit("")))
    return F.when(low.contains("png"), "png").when(low.contains("jpeg") | low.contains("jpg"), "jpg").when(low.contains("webp"), "webp").otherwise("bin")


def is_safe_name(name: Column, kind: str) -> Column:
    return F.coalesce(name.rlike(SAFE_NAMES[kind]), F.lit(False))


def relative_path(path: Column) -> Column:
    """Without slashes at its ends; null if any part climbs."""
    bare = F.regexp_replace(path, "^/+|/+$", "")
    return F.when(~bare.contains(".."), bare)


def season_range(year: Column, start: str, end: str) -> Column:
    """An inclusive range of days of a year, as two UTC instants."""
    y = year.cast("string")
    return F.concat(y, F.lit(f"-{start}T00:00:00Z/"), y, F.lit(f"-{end}T23:59:59Z"))


def cell_id(size: int | float, ix: Column, iy: Column, prefix: str = "utm42n") -> Column:
    shown = str(int(size)) if float(size).is_integer() else str(size)
    return F.concat(F.lit(f"{prefix}_{shown}m_"), ix.cast("string"), F.lit("_"), iy.cast("string"))


def facade_variant(feature: Column) -> Column:
    """The number after the first slash, or the whole id, modulo 3; 0 if it is none."""
    tail = F.when(F.instr(feature, "/") > 0, F.element_at(F.split(feature, "/", 2), 2)).otherwise(feature)
    return F.coalesce(F.abs(tail.try_cast("bigint")) % 3, F.lit(0).cast("bigint"))


def colour_stop(value: Column, stops: list[tuple[float, float]]) -> Column:
    """Piecewise linear between (position, value) stops, constant outside."""
    out = F.when(value <= stops[0][0], F.lit(stops[0][1]))
    for (x0, y0), (x1, y1) in zip(stops, stops[1:], strict=False):
        out = out.when(value <= x1, F.lit(y0) + (value - x0) * F.lit((y1 - y0) / (x1 - x0)))
    return out.otherwise(F.lit(stops[-1][1]))


#: Parts of names of models that may not be used, and the rules that follow every prompt.
DENIED_MODELS = ("gemini-2.",)
GUARDRAILS = [
    "Hard constraints:",
    "- Do not copy the anchors or neighbors; use them only as style references.",
    "- Do not introduce new large objects that cross tile boundaries.",
    "- Keep global lighting/camera consistent with the anchors.",
]
KEEP_ROOFS = "- Preserve per-building roof colors/materials from the {} tile; avoid homogenizing everything."
LEAN_ON_REFERENCE = "- Lean on the COLOR REFERENCE to keep Tashkent-specific turquoise/mint/blue roofs instead of drifting toward generic browns."


def is_allowed_model(model: Column, denied: tuple[str, ...] = DENIED_MODELS) -> Column:
    """No denied part in any case; no name at all is allowed."""
    low = F.lower(F.trim(F.coalesce(model, F.lit(""))))
    allowed = F.lit(True)
    for part in denied:
        allowed = allowed & ~low.contains(part)
    return allowed


def assembled_prompt(template: Column, layer: Column, referenced: Column) -> Column:
    """The template with its label renamed, and the rules that its layer and a colour reference call for."""
    user = F.trim(F.replace(F.replace(F.coalesce(template, F.lit("")), F.lit("labeled WHITEBOX"), F.lit("labeled INPUT TILE")), F.lit("WHITEBOX"), F.lit("INPUT TILE")))
    lines = lambda *more: F.lit("\n".join([GUARDRAILS[0], *more, *GUARDRAILS[1:]]))
    plain = F.lower(F.coalesce(layer, F.lit(""))).contains("whitebox")
    rules = F.when(referenced, lines(KEEP_ROOFS.format("COLOR REFERENCE"), LEAN_ON_REFERENCE)).when(~plain, lines(KEEP_ROOFS.format("input"))).otherwise(lines())
    return F.trim(F.concat(user, F.lit("\n\n"), rules))


def structure_weights(layer: str, referenced: bool) -> dict[str, float]:
    """Colour counts more where a layer has true colours or a reference shows them."""
    if referenced or "whitebox" not in (layer or "").lower():
        return {"rgb_l1": 1.0, "rgb_l2": 0.0, "sobel_l1": 0.5}
    return {"rgb_l1": 0.15, "rgb_l2": 0.0, "sobel_l1": 1.0}


def path_below(root: Column, path: Column) -> Column:
    """A path below a root as seen from there, the root itself as a dot; other paths stay."""
    base = F.regexp_replace(root, "/+$", "")
    return F.when(path == base, F.lit(".")).when(F.startswith(path, F.concat(base, F.lit("/"))), F.substring(path, F.length(base) + 2, F.length(path))).otherwise(path)
