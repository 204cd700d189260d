"""Questionnaire answers kept as JSON text, written either as a list or as an object.

Both ``[{"variable": 4, "value": 13}, ...]`` and
``{"396654": {"variable": "4", "value": "14"}, ...}`` occur, with or without a
``{"values": ...}`` wrapper. Order matters ("first answer"), so the readers go
through map / array parsing, which keeps document order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keys under which an entry may hold its variable and its value.
_ENTRY = "struct<variable:string,value:string,var:string,val:string>"
_LIST = f"array<{_ENTRY}>"
_OBJECT = f"map<string,{_ENTRY}>"
_TYPED = "array<struct<variable:int,value:string>>"


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` written once into the plan however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _entries(text: Column) -> Column:
    """Entries of one list or object in document order; NULL if unreadable."""

    def read(t: Column) -> Column:
        is_list = F.ltrim(t).startswith("[")
        return F.when(is_list, F.from_json(t, _LIST)).otherwise(F.map_values(F.from_json(t, _OBJECT)))

    plain = lambda e: F.struct(
        F.coalesce(e["variable"], e["var"]).alias("variable"), F.coalesce(e["value"], e["val"]).alias("value")
    )
    return F.transform(_with(text, read), plain)


def parsed(answers: Column) -> Column:
    """A questionnaire's text read once: ``struct<entries, wrapped_object>``.

    Put it into a column of its own (``withColumn``) and give that column to the
    functions below; Spark then parses each text one time for all of them.
    ``wrapped_object`` tells an object inside ``values`` apart.
    """

    def read(inner: Column) -> Column:
        return F.struct(
            _entries(F.coalesce(inner, answers)).alias("entries"),
            F.coalesce(~F.ltrim(inner).startswith("["), F.lit(False)).alias("wrapped_object"),
        )

    return _with(F.get_json_object(answers, "$.values"), read)


def answer_list(questionnaire: Column) -> Column:
    """All answers of a ``parsed`` questionnaire as ``array<struct<variable:int,value:string>>``.

    Empty where the text is missing or unreadable, or where any variable is not
    a number (one bad entry discards the questionnaire).
    """
    entries = questionnaire["entries"]
    bad = F.exists(entries, lambda e: e["variable"].isNotNull() & e["variable"].try_cast("int").isNull())
    typed = F.transform(
        entries,
        lambda e: F.struct(
            F.coalesce(e["variable"].try_cast("int"), F.lit(0)).alias("variable"),
            F.coalesce(e["value"], F.lit("")).alias("value"),
        ),
    )
    return F.when(entries.isNull() | bad, F.array().cast(_TYPED)).otherwise(typed)


def first_code(questionnaire: Column, codes: Sequence[int], wrapped_objects: bool = False) -> Column:
    """The first value out of ``codes`` in a ``parsed`` questionnaire, whatever variable it answers.

    The reports read a bare list, a bare object, and a wrapped list, but not an
    object inside ``values``; ``wrapped_objects=True`` reads that one too.
    """
    numbers = F.transform(questionnaire["entries"], lambda e: e["value"].try_cast("int"))
    code = F.get(F.filter(numbers, lambda n: n.isin(list(codes))), F.lit(0))
    return code if wrapped_objects else F.when(~questionnaire["wrapped_object"], code)


def code_by_precedence(fields: Column, codes: Sequence[int], path: str = "$.diagnostic.values") -> Column:
    """The first of ``codes`` (in the given order) that any answer in the text ``fields`` holds."""
    values = F.transform(_entries(F.get_json_object(fields, path)), lambda e: e["value"])
    wanted = F.array(*[F.lit(str(c)) for c in codes])
    return F.get(F.array_intersect(wanted, values), F.lit(0)).cast("int")


def answer_to(questionnaire: Column, variables: Sequence[int]) -> Column:
    """The answer of a ``parsed`` questionnaire to the first of ``variables`` that was asked."""
    asked = F.transform(
        questionnaire["entries"], lambda e: F.struct(e["variable"].try_cast("int").alias("variable"), e["value"].alias("value"))
    )

    def first_of(variable: int) -> Column:
        return F.get(F.filter(asked, lambda e: e["variable"] == F.lit(variable)), F.lit(0))

    result = None
    for variable in variables:
        first = first_of(variable)
        result = F.when(first.isNotNull(), first["value"]) if result is None else result.when(first.isNotNull(), first["value"])
    return result


def labelled(code: Column, labels: dict[str, Sequence[str]], default: str | None = "Unknown") -> Column:
    """``{label: [codes]}`` looked up; ``default`` for any other code or none."""
    key = F.trim(code.cast("string"))
    result = None
    for label, codes in labels.items():
        hit = key.isin([str(c) for c in codes])
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result.otherwise(F.lit(default))
