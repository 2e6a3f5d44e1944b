"""What goes to a model and what comes back: request bodies, texts of responses, views that are safe to keep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .audit import SECRET_KEYS

#: Reasoning efforts, those that one style knows, and the tokens that its high one may think with.
EFFORTS = ("none", "minimal", "low", "medium", "high", "xhigh")
MESSAGE_EFFORTS, THINKING_TOKENS, LONG_OUTPUT, SHORT_OUTPUT = ("none", "high"), 16_000, 32_768, 8_192
#: Kinds of blocks, and names of fields, that hold what a model thought.
THOUGHT_BLOCKS = ("thinking", "redacted_thinking", "reasoning")
THOUGHT_FIELDS = ("reasoning_content", "reasoning_details", "thinking", "signature", "encrypted_content", "redacted_data")

#: The API styles.
STYLES = ("responses", "chat_completions", "messages")
#: Levels below the outermost that the views go down unless told otherwise. Each takes stack while a pattern is matched.
DEPTH = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, VOID or a kind of number; null where there is no value."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _is_object(value: Column) -> Column:
    """Looks at the value itself and not, as a schema does, at all that it holds."""
    return F.try_variant_get(value, "$", "map<string,variant>").isNotNull()


def _is_array(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>").isNotNull()


def _at(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _each(value: Column) -> Column:
    """Elements of an array. A field that is not there, and a string or object without content, have none; null for all else."""
    none = F.from_json(F.lit("[]"), "array<variant>")
    empty = (_kind(value) == "STRING") & (_text(value) == "") | _is_object(value) & (F.to_json(value) == "{}")
    return F.when(value.isNull(), none).when(_is_array(value), F.try_variant_get(value, "$", "array<variant>")).when(empty, none)


def _joined(parts: Column, kind: str) -> Column:
    """The texts of the parts of a kind, one after another; null if a part is no object, or its text no string."""
    own = lambda p: F.coalesce((_kind(_at(p, "type")) == "STRING") & (_text(_at(p, "type")) == kind), F.lit(False))
    wrong = lambda p: ~_is_object(p) | own(p) & F.coalesce(_kind(_at(p, "text")) != "STRING", F.lit(False))
    said = F.array_join(F.transform(F.filter(parts, own), lambda p: F.coalesce(_text(_at(p, "text")), F.lit(""))), "")
    return F.when(~F.exists(parts, wrong), said)


def _outputs(parts: Column) -> Column:
    """The texts of all messages among the outputs; null if one is malformed."""
    said = lambda o: F.when((_kind(_at(o, "type")) == "STRING") & (_text(_at(o, "type")) == "message"), _joined(_each(_at(o, "content")), "output_text")).otherwise("")
    texts = F.transform(parts, lambda o: F.when(_is_object(o), said(o)))
    return F.when(~F.exists(texts, F.isnull), F.array_join(texts, ""))


def response_text(style: Column, raw: Column) -> Column:
    """text and problem of a raw JSON response, as its API style has it. Problems, the first that holds: unknown_style;
    malformed (no JSON object, a usage that is no object, or parts of another type than the style has); incomplete; no_text.

    Types are looked at before values are read, so a number is never taken for a text. An object that names a field twice
    is no JSON here.
    """

    def answer(v: Column) -> Column:
        choices = _at(v, "choices")
        nothing = choices.isNull() | _kind(choices).isin("VOID") | F.to_json(choices).isin("[]", "{}", '""', "false", "0")
        choice = F.try_variant_get(choices, "$[0]", "variant")
        message = _at(choice, "message")
        malformed = F.struct(F.lit("malformed").alias("problem"), F.lit(None).cast("string").alias("text"))
        said = lambda text: F.when(text.isNull(), malformed).otherwise(F.struct(F.when(text == "", "no_text").alias("problem"), text.alias("text")))
        problem = lambda name: F.struct(F.lit(name).alias("problem"), F.lit(None).cast("string").alias("text"))
        status = _at(v, "status")
        responses = F.when(status.isNull() | (_kind(status) == "VOID") | (_kind(status) == "STRING") & (_text(status) == "completed"), said(_outputs(_each(_at(v, "output"))))).otherwise(problem("incomplete"))
        finished = F.coalesce((_kind(_at(choice, "finish_reason")) == "STRING") & (_text(_at(choice, "finish_reason")) == "stop"), F.lit(False))
        content = F.when(_kind(_at(message, "content")) == "STRING", _text(_at(message, "content"))).otherwise("")
        chat = (
            F.when(nothing, problem("incomplete"))
            .when(~_is_array(choices) | ~_is_object(choice), malformed)
            .when(~finished, problem("incomplete"))
            .when(message.isNotNull() & ~_is_object(message), malformed)
            .otherwise(said(content))
        )
        reason = _at(v, "stop_reason")
        ended = F.coalesce((_kind(reason) == "STRING") & (_text(reason) == "end_turn"), F.lit(False))
        blocks = F.when(ended, said(_joined(_each(_at(v, "content")), "text"))).otherwise(problem("incomplete"))
        usage = _at(v, "usage")
        whole = _is_object(v) & (usage.isNull() | _is_object(usage))
        by_style = F.when(style == STYLES[0], responses).when(style == STYLES[1], chat).otherwise(blocks)
        return F.when(~F.coalesce(style.isin(*STYLES), F.lit(False)), problem("unknown_style")).when(F.coalesce(whole, F.lit(False)), by_style).otherwise(malformed)

    found = _let(F.try_parse_json(raw), answer)
    return F.struct(F.when(found["problem"].isNull(), found["text"]).alias("text"), found["problem"].alias("problem"))


def effort_problem(style: Column, effort: Column) -> Column:
    """Why a request cannot be made, or null."""
    return F.when(~F.coalesce(style.isin(*STYLES), F.lit(False)), "unknown_style").when(~effort.isin(*EFFORTS), "unknown_effort").when((style == "messages") & ~effort.isin(*MESSAGE_EFFORTS), "effort_not_in_style")


def request_body(style: Column, model: Column, system: Column, content: Column, effort: Column, most: int) -> Column:
    """The JSON body of a request, whose fields depend on the API style; a chat names an effort only if there is one."""
    said = lambda role, what: F.struct(F.lit(role).alias("role"), what.alias("content"))
    high = effort == "high"
    responses = F.struct(model.alias("model"), system.alias("instructions"), content.alias("input"), F.lit(False).alias("store"), F.struct(effort.alias("effort")).alias("reasoning"), F.lit(most).alias("max_output_tokens"))
    chat = F.struct(model.alias("model"), F.array(said("system", system), said("user", content)).alias("messages"), F.lit(most).alias("max_tokens"), F.struct(F.lit("json_object").alias("type")).alias("response_format"), F.when(effort != "none", effort).alias("reasoning_effort"))
    thinking = F.struct(F.when(high, "enabled").otherwise("disabled").alias("type"), F.when(high, THINKING_TOKENS).alias("budget_tokens"))
    messages = F.struct(model.alias("model"), system.alias("system"), F.array(said("user", content)).alias("messages"), F.when(high, LONG_OUTPUT).otherwise(SHORT_OUTPUT).alias("max_tokens"), thinking.alias("thinking"))
    return F.when(effort_problem(style, effort).isNull(), F.when(style == "responses", F.to_json(responses)).when(style == "chat_completions", F.to_json(chat)).when(style == "messages", F.to_json(messages)))


#: Pieces of JSON as patterns: a string, and what is no string and in no nested value. Repeats are possessive, so they take no
#: stack and are never tried again.
_STRING, _PLAIN = r'"(?:[^"\\]++|\\.)*+"', r'[^"\[\]{}]++'


def _value(depth: int) -> str:
    """Pattern of a JSON value with at most `depth` levels below it."""
    nested = r"[\[{][\]}]"
    for _ in range(depth):
        nested = rf"[\[{{](?:{_PLAIN}|{_STRING}|{nested})*+[\]}}]"
    return rf'(?:{_STRING}|[^",\[\]{{}}]++|{nested})'


def _replaced(json: Column, skipped: str, found: str, by: str) -> Column:
    """JSON with each `found` outside of strings replaced. Matches begin where the last one ended, so none begins within a
    string; `skipped` says what else may lie between. `by`: $1 is what was skipped."""
    return F.regexp_replace(json, rf"\G((?:{skipped})*+){found}", by)


def canonical_json(value: Column, depth: int = DEPTH) -> Column:
    """A variant as JSON in one form, whatever the order its fields came in: fields by name, ', ' and ': ' between, characters
    as they are, numbers as Spark writes them. Null for no value, and for one that is nested deeper than `depth`: there is no
    view of a part."""
    compact = F.when(value.isNotNull(), F.coalesce(F.to_json(value), F.lit("null")))
    whole = F.nullif(F.regexp_extract(compact, rf"^{_value(depth)}$", 0), F.lit(""))
    return _replaced(whole, rf'[^",:]++|{_STRING}', "([,:])", "$1$2 ")


def without_thoughts(form: Column, depth: int = DEPTH) -> Column:
    """Canonical JSON without what a model thought: such blocks keep their kind alone, such fields go."""
    gone, value = rf'"(?:{"|".join(THOUGHT_FIELDS)})": ', _value(depth)
    kept = _replaced(form, rf'[^",]++|(?!{gone}){_STRING}|(?!, {gone}),', rf"(?:(?:, {gone}{value})++|(?:{gone}{value}(?:, )?+)++)", "$1")
    field = rf"{_STRING}: {value}"
    block = rf'\{{(?:(?!"type":){field}, )*+"type": "({"|".join(THOUGHT_BLOCKS)})"(?:, {field})*+\}}'
    return _replaced(kept, rf'[^"{{]++|{_STRING}|(?!{block})\{{', block, '$1{"omitted": true, "type": "$2"}')


def without_secrets(form: Column, depth: int = DEPTH) -> Column:
    """Canonical JSON with the values of secret fields replaced, at any level."""
    # what `normal_key` leaves out of a name; two letters beyond ASCII have k and i as lower case
    other = r'(?:[^A-Za-z\u0130\u212A"\\]++|\\(?:u[0-9A-Fa-f]{4}|[^u]))*+'
    letter = lambda c: f"[{c}{c.upper()}{dict(i=chr(0x130), k=chr(0x212A)).get(c, '')}]"
    names = rf'"{other}(?:{"|".join(other.join(map(letter, key)) for key in SECRET_KEYS)}){other}": '
    return _replaced(form, rf'[^"]++|(?!{names}){_STRING}', rf"({names}){_value(depth)}", '$1$2"[REDACTED]"')


def visible_response(value: Column, depth: int = DEPTH) -> Column:
    """A response (a variant) as canonical JSON without what the model thought."""
    return without_thoughts(canonical_json(value, depth), depth)


def redacted_json(value: Column, depth: int = DEPTH) -> Column:
    """A variant as canonical JSON with the values of secret fields replaced."""
    return without_secrets(canonical_json(value, depth), depth)


def canonical_hash(value: Column, depth: int = DEPTH) -> Column:
    return F.sha2(canonical_json(value, depth).cast("binary"), 256)
