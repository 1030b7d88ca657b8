"""Column functions over records: JSON payloads, keys, hashes, casts and timestamps."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(payload: Column) -> Column:
    """A payload with sorted keys and without blanks; null if it is not JSON (or repeats a key)."""
    return F.to_json(F.try_parse_json(payload))


def content_hash(payload: Column) -> Column:
    """SHA-256 of the canonical payload, the identity of a record's content; of the text itself where that is not JSON."""
    return F.sha2(F.coalesce(canonical_json(payload), payload), 256)


def row_hash(fields: dict[str, Column]) -> Column:
    """SHA-256 over the fields whose names don't begin with an underscore, in the order of their names."""
    named = [f.alias(n) for n, f in sorted(fields.items()) if not n.startswith("_")]
    return F.sha2(F.to_json(F.struct(*named), {"ignoreNullFields": "false"}), 256)


def idempotency_key(connector: str, datatype: str, key: Column, digest: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(connector), F.lit(datatype), key, digest), 256)


def path_steps(path: str) -> list[tuple[str, str]]:
    """(name, indexes) of each step of a dotted path; a name in double quotes may hold any characters, as in JSON."""
    step = re.compile(r"""("(?:[^"\\]|\\.)*"|[^."\[\]]+)((?:\[\d+\])*)(\.|$)""")
    steps, at = [], 0
    while at < len(path) or not steps:
        found = step.match(path, at)
        if not found or (found[3] and found.end() == len(path)):
            raise ValueError(f"not a path of names and indexes: {path}")
        steps.append((json.loads(found[1]) if found[1][0] == '"' else found[1], found[2]))
        at = found.end()
    return steps


def dot_path(payload: Column, path: str) -> Column:
    """The value under a dotted path as a string; null where a step is missing.

    A step is a name, with indexes like ``[0]`` behind it; a name with dots, brackets or quotes stands in double quotes, as in JSON. Objects
    and arrays come as JSON. ``concord.functions.jmespath`` has more than paths.
    """
    steps = path_steps(path)
    if not any(set(name) & set("'?") for name, _ in steps):
        return F.get_json_object(payload, "$" + "".join(f"['{name}']{at}" for name, at in steps))
    from . import jmespath

    value = F.try_parse_json(payload)
    for name, at in steps:
        value = jmespath.build(("field", name), value)
        for index in re.findall(r"\d+", at):
            value = jmespath.build(("index", int(index)), value)
    return jmespath.text(value)


def cast_or_default(value: Column, kind: str, default=None) -> Column:
    """A text value as str, int, float, bool, date or datetime; the default where it is missing or does not fit.

    Booleans follow truthiness: every non-empty text is true.
    """
    if kind == "bool":
        made = F.when(value.isNotNull(), value != "")
    else:
        made = value.try_cast({"str": "string", "int": "bigint", "float": "double", "date": "date", "datetime": "timestamp"}[kind])
    return made if default is None else F.coalesce(made, F.lit(default))


def composite_key(*parts: Column) -> Column:
    """Parts joined by ':'; null as soon as one part is null."""
    whole = F.concat_ws(":", *parts)
    for p in parts:
        whole = F.when(p.isNotNull(), whole)
    return whole


def _utc(ts: Column) -> Column:
    """The UTC wall clock of a timestamp, by plain arithmetic, so no time zone's gaps or folds matter."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.unix_seconds(ts).cast("decimal(18,6)"))


def _written(clock: Column) -> Column:
    return F.concat(F.regexp_replace(F.replace(clock.cast("string"), F.lit(" "), F.lit("T")), r"\.\d+$", ""), F.lit("Z"))


def iso(ts: Column) -> Column:
    """A timestamp as YYYY-MM-DDTHH:MM:SSZ in UTC, whatever the session's time zone."""
    return _written(_utc(ts))


def _clock(text: Column) -> Column:
    """The UTC wall clock that a text names; without an offset of its own it is in UTC. Null where it can't be read."""
    offset = F.regexp_like(text, F.lit(r"(?i)[0-9]:[0-9].*[0-9]\s*(Z|UTC|[+-][0-9]{1,2}(:?[0-9]{2})?)\s*$"))
    return F.when(offset, _utc(F.try_to_timestamp(text))).otherwise(text.try_cast("timestamp_ntz"))


def normalize_timestamp(value: Column, kind: str = "auto") -> Column:
    """A text timestamp as YYYY-MM-DDTHH:MM:SSZ; what can't be read stays as it is.

    kind: iso8601, unix_seconds, unix_millis, rfc2822 or auto. In auto, numbers above 1e10 are milliseconds. The result does
    not depend on the session's time zone.
    """
    number = value.try_cast("double")
    seconds = F.timestamp_seconds(F.floor(number).cast("long"))
    millis = F.timestamp_millis(F.floor(number).cast("long"))
    rfc = F.try_to_timestamp(F.regexp_replace(value, r"^[A-Za-z]{3},\s*", ""), F.lit("d MMM yyyy HH:mm:ss Z"))
    text = F.when(number.isNull(), _clock(value))
    made = {
        "iso8601": text,
        "unix_seconds": _utc(seconds),
        "unix_millis": _utc(millis),
        "rfc2822": _utc(rfc),
        "auto": F.coalesce(_utc(F.when(number > 1e10, millis).when(number.isNotNull(), seconds)), text, _utc(rfc)),
    }[kind]
    return F.coalesce(_written(made), value)


def glob_regex(pattern: str) -> str:
    """A shell pattern (* ? [..]) as an anchored regular expression."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += "(?s:.*)"
        elif c == "?":
            out += "(?s:.)"
        elif close > 0:
            inner = pattern[i + 1 : close].replace("\\", "\\\\")
            out += "[" + ("^" + inner[1:] if inner[0] == "!" else inner) + "]"
            i = close
        else:
            out += re.escape(c)
        i += 1
    return rf"\A{out}\z"


def matches_glob(value: Column, pattern: str) -> Column:
    return value.rlike(glob_regex(pattern))


def full_match(value: Column, pattern: str) -> Column:
    return value.rlike(rf"\A(?:{pattern})\z")


def back_off(attempt: Column, base: float, multiplier: float, ceiling: float) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(multiplier), attempt), F.lit(ceiling))


def seconds(duration: str) -> float:
    """30s, 5m, 1h or 90d in seconds."""
    found = re.fullmatch(r"(\d+(?:\.\d+)?)([smhd])", duration.strip())
    if not found:
        raise ValueError(f"not a duration: {duration!r}")
    return float(found[1]) * {"s": 1, "m": 60, "h": 3600, "d": 86400}[found[2]]


def lock_key(name: Column) -> Column:
    """A signed 64-bit number from the first half of a name's MD5."""
    return F.conv(F.substring(F.md5(name), 1, 16), 16, -10).cast("long")


def hmac_sha256(secret: str, body: Column) -> Column:
    """HMAC-SHA256 of a text or binary column as lower-case hex, from two built-in digests."""
    import hashlib

    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(k ^ pad for k in key)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, body.cast("binary")), 256))), 256)


def signature_valid(secret: str, body: Column, signature: Column, encoding: str = "hex", sent_at: Column | None = None, now: Column | None = None, skew: int = 300) -> Column:
    """Whether a signature belongs to a body; with ``sent_at`` (epoch seconds) it covers "<sent_at>.<body>" and may be
    ``skew`` seconds off ``now``. Hex signatures may have a prefix like ``sha256=`` or ``v1=``. Null signatures are invalid."""
    signed = body if sent_at is None else F.concat(sent_at.cast("string"), F.lit("."), body)
    made = hmac_sha256(secret, signed)
    if encoding == "base64":
        good = F.base64(F.unhex(made)) == signature
    else:
        good = made == F.regexp_replace(signature, r"\A(sha256|v1)=", "")
    if sent_at is not None and now is not None:
        good = good & (F.abs(F.unix_seconds(now) - sent_at) <= skew)
    return F.coalesce(good, F.lit(False))


def name_rule(left: Column, right: Column, same_below: int = 3, differ_above: int = 5) -> Column:
    """auto_link, queue_for_review or undecided, by the edit distance of two names; null where a name is missing."""
    distance = F.levenshtein(left, right)
    return F.when(distance < same_below, "auto_link").when(distance > differ_above, "queue_for_review").when(distance.isNotNull(), "undecided")
