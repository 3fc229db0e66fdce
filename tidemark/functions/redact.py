"""Removal of secrets from text, from maps and structs by key name, and from JSON text."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = "***REDACTED***"

#: Long s, Kelvin sign, dotless i and dotted I equal s, k and i when case is ignored.
CASE_PARTNERS = ("\u017f", "\u212a", "\u0131", "\u0130")

# Key names and value patterns that mark a secret.
KEY_WORDS = ("token", "password", "secret", "api_key", "access_token", "authorization", "ciphertext")
VALUE_WORDS = ("token", "password", "secret", "api_key", "bearer")
EXACT_KEYS = (
    "access_token", "master_key", "card_number", "secret_key",
    "password", "token", "api_key", "api_secret",
)

# White space as a Unicode-aware regular expression sees it, spelled out for Java.
_SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_VALUE = rf"""[^{_SPACE}"',&]"""

def _any_case(words: tuple[str, ...]) -> str:
    """Java's case folding leaves out the dotted and the dotless i, so they are written out."""
    return "|".join(w.replace("i", "[i\u0130\u0131]") for w in words)


_VALUE_PATTERN = (
    rf"""(?iu)({_any_case(VALUE_WORDS)})["']?[{_SPACE}]*[:=][{_SPACE}]*["']?{_VALUE}{{4,}}({_VALUE}{{4}})"""
)
_KEY_PATTERN = rf"(?iu)({_any_case(KEY_WORDS)})"


def redact_text(text: Column | str) -> Column:
    """Replace ``key: value`` secrets of eight or more characters by ``key=***last4``."""
    c = F.col(text) if isinstance(text, str) else text
    # A plain search rules out most texts before the much slower pattern runs. These signs are
    # the only ones outside ASCII that match a letter of the words when case is ignored.
    folded = F.lower(c)
    candidate = F.lit(False)
    for sign in CASE_PARTNERS:
        candidate = candidate | c.contains(sign)
    for word in VALUE_WORDS:
        candidate = candidate | folded.contains(word)
    return F.when(candidate, F.regexp_replace(c, _VALUE_PATTERN, "$1=***$2")).otherwise(c)


def redact_map(fields: Column) -> Column:
    """Mask the values of secret key names in a string map, and secrets inside other values."""
    return F.transform_values(
        fields, lambda k, v: F.when(k.rlike(_KEY_PATTERN), F.lit(MASK)).otherwise(redact_text(v))
    )


def redact_map_exact(fields: Column, names: tuple[str, ...] = EXACT_KEYS) -> Column:
    """Mask the values of exactly these key names."""
    return F.transform_values(fields, lambda k, v: F.when(k.isin(*names), F.lit(MASK)).otherwise(v))


def redact_nested(value: Column, data_type: T.DataType) -> Column:
    """Redact a nested value of known type: fields by name, strings by pattern, at every depth.

    A field with a secret name becomes the mask, so its type becomes string.
    """
    if isinstance(data_type, T.StringType):
        return redact_text(value)
    if isinstance(data_type, T.StructType):
        masked = F.struct(
            *(
                (F.lit(MASK) if _secret(f.name) else redact_nested(value.getField(f.name), f.dataType))
                .alias(f.name)
                for f in data_type.fields
            )
        )
        return F.when(value.isNotNull(), masked)
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: redact_nested(x, data_type.elementType))
    if isinstance(data_type, T.MapType):
        inner = data_type.valueType
        if isinstance(inner, T.StringType):
            return redact_map(value)
        return F.transform_values(value, lambda _, v: redact_nested(v, inner))
    return value


_secret = re.compile(f"(?i){'|'.join(KEY_WORDS)}").search


def redact_json(payload: Column | str) -> Column:
    """Redact JSON text whose schema is not known; text that is no JSON is redacted as text.

    Numbers come out as they were written, and keys that repeat stay. Half of a surrogate pair becomes a question mark.
    """
    key_words, value_words, mask = "|".join(KEY_WORDS), "|".join(VALUE_WORDS), MASK

    # Everything is local so that workers need not import this package.
    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        import json
        import re

        secret_key = re.compile(f"(?i){key_words}")
        secret_value = re.compile(
            rf"""(?i)({value_words})["']?\s*[:=]\s*["']?[^\s"',&]{{4,}}([^\s"',&]{{4}})"""
        )

        class Pairs(list):
            """The entries of an object."""

        class Number(str):
            """A number as it was written."""

        def clean(text):
            return secret_value.sub(r"\1=***\2", text)

        def written(node):
            if isinstance(node, Pairs):
                entries = (
                    f"{json.dumps(k, ensure_ascii=False)}: {json.dumps(mask) if secret_key.search(k) else written(v)}"
                    for k, v in node
                )
                return "{" + ", ".join(entries) + "}"
            if isinstance(node, list):
                return "[" + ", ".join(map(written, node)) + "]"
            if isinstance(node, Number):
                return str(node)
            return json.dumps(clean(node) if isinstance(node, str) else node, ensure_ascii=False)

        def one(text):
            if text is None:
                return None
            try:
                node = json.loads(
                    text, object_pairs_hook=Pairs, parse_float=Number, parse_int=Number, parse_constant=Number
                )
                return written(node).encode("utf-8", "replace").decode("utf-8")
            except ValueError:
                return clean(text)

        return texts.map(one)

    return redact(F.col(payload) if isinstance(payload, str) else payload)


# Possessive loops: Java's others recurse and overflow on long strings.
_JSON_TOKEN = r'(?s)"[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\]:,]|[^ \t\n\r{}\[\]:,"]++|"'
_JSON_STRING = r'^"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"\z'
_JSON_LITERAL = r"^(?:true|false|null|NaN|-?Infinity|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)\z"
_JSON_SIGNS = ("{", "}", "[", "]", ":", ",")
_JSON_ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _json_text(plain: Column) -> Column:
    """A string as JSON writes it, other letters than ASCII left as they are."""
    out = plain
    for sign, written in _JSON_ESCAPES.items():
        out = F.replace(out, F.lit(sign), F.lit(written))
    rare = out
    for code in range(32):
        if chr(code) not in _JSON_ESCAPES:
            rare = F.replace(rare, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    needed = F.when(out.rlike(r"[\x00-\x1f]"), rare).otherwise(out)
    return F.concat(F.lit('"'), F.when(plain.rlike(r'[\x00-\x1f"\\]'), needed).otherwise(plain), F.lit('"'))


def _json_plain(token: Column) -> Column:
    escaped = F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>")[0]
    return F.when(token.contains("\\"), escaped).otherwise(F.substring(token, F.lit(2), F.length(token) - 2))


def _json_step(state: Column, kind: Column) -> Column:
    """The state behind one more token: open containers, what may follow, and places of secret values.

    What may follow: v a value, e a value or the end of a list, k a key or the end of an object, K a key, a colon,
    a comma (or an end), d nothing, x the text is no JSON.
    """
    stack, want, hidden, at = (state[c] for c in ("stack", "want", "hidden", "at"))
    top, value = F.right(stack, F.lit(1)), want.isin("v", "e")
    opens, scalar = value & kind.isin("{", "["), value & kind.isin("s", "l")
    closes = ((kind == "}") & (top == "{") & want.isin("k", ",")) | ((kind == "]") & (top == "[") & want.isin("e", ","))
    key = want.isin("k", "K") & kind.isin("s", "S")
    left = F.when(opens, F.concat(stack, kind)).when(
        closes, F.substring(stack, F.lit(1), F.length(stack) - 1)
    ).otherwise(stack)
    follows = (
        F.when(opens, F.when(kind == "{", "k").otherwise("e"))
        .when(scalar | closes, F.when(left == "", "d").otherwise(","))
        .when(key, ":")
        .when((kind == ":") & (want == ":"), "v")
        .when((kind == ",") & (want == ",") & (stack != ""), F.when(top == "{", "K").otherwise("v"))
        .otherwise("x")
    )
    begins = key & (kind == "S") & (hidden == 0)
    ends = (hidden > 0) & (scalar | closes) & (F.length(left) == hidden)
    span = F.struct(state["begin"].alias("begin"), at.alias("end"))
    return F.struct(
        left.alias("stack"), follows.alias("want"),
        F.when(begins, F.length(stack)).when(ends, 0).otherwise(hidden).alias("hidden"),
        F.when(begins, at + 2).otherwise(state["begin"]).alias("begin"), (at + 1).alias("at"),
        F.when(ends, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
    )


def redact_json_native(payload: Column | str) -> Column:
    """What ``redact_json`` gives, by built-in functions alone: no Python worker.

    The text is cut into tokens; one fold over them checks the grammar and finds where values of secret keys begin
    and end. Time is linear in tokens, but for the number of
    secret values of one text, which are appended one by one.
    """
    text = F.col(payload) if isinstance(payload, str) else payload
    start = F.struct(
        F.lit("").alias("stack"), F.lit("v").alias("want"), F.lit(0).alias("hidden"), F.lit(0).alias("begin"),
        F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("spans"),
    )

    def kinds(tokens: Column) -> Column:
        def kind(token: Column, i: Column) -> Column:
            named = (F.get(tokens, i + 1) == ":") & _json_plain(token).rlike(_KEY_PATTERN)
            return (
                F.when(token.isin(*_JSON_SIGNS), token)
                .when(token.rlike(_JSON_STRING), F.when(named, "S").otherwise("s"))
                .when(token.rlike(_JSON_LITERAL), "l").otherwise("x")
            )
        return F.transform(tokens, kind)

    def written(tokens: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            said = _let(_json_plain(token), lambda plain: _json_text(
                F.when(F.get(tokens, i + 1) == ":", plain).otherwise(redact_text(plain))
            ))
            return (
                F.when(token == ",", ", ").when(token == ":", ": ").when(token.startswith('"'), said).otherwise(token)
            )
        return F.transform(tokens, one)

    def joined(parts: Column, spans: Column) -> Column:
        def behind(span: Column) -> Column:
            return F.coalesce(span["end"] + 1, F.lit(0))

        shown = F.transform(spans, lambda span, j: _let(behind(F.get(spans, j - 1)), lambda first: F.concat(
            F.array_join(F.slice(parts, first + 1, span["begin"] - first), ""), F.lit(f'"{MASK}"')
        )))
        rest = _let(behind(F.get(spans, F.size(spans) - 1)), lambda first: F.array_join(
            F.slice(parts, first + 1, F.size(parts) - first), ""
        ))
        return F.concat(F.array_join(shown, ""), rest)

    def redacted(tokens: Column) -> Column:
        walked = F.aggregate(kinds(tokens), start, _json_step)
        return _let(walked, lambda end: F.when(
            end["want"] == "d", _let(written(tokens), lambda parts: joined(parts, end["spans"]))
        ))

    tokens = F.regexp_extract_all(text, F.lit(_JSON_TOKEN), F.lit(0))
    return F.coalesce(_let(tokens, redacted), redact_text(text))
