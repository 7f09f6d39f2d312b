"""Tables around model calls: requests out, replies in. No model runs here."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import unroll
from graphloom.session import materialize

TEXT_SLOT = "{text}"

TRIPLE_TEMPLATE = (
    "Read the text below and reply only with rows of the form (ENTITYONE, RELATIONSHIP, ENTITYTWO), one per line.\n{text}"
)
SUMMARY_SYSTEM = "Summarise the given triples. Begin with the summary itself."
SUMMARY_TEMPLATE = "These nodes and relationships form one community of a graph. Describe it in plain prose.\n{text}\nSummary:"
RESOLUTION_SYSTEM = (
    "Find names in the list that stand for the same thing. Spelling and format variants are the same. "
    "Names with different numbers, dates or products are not."
)
RESOLUTION_TEMPLATE = "List of names:\n{text}\nReturn the lists of names to merge."

# The grid of a sweep.
SWEEP_TEMPERATURES = (0.6, 0.7)
SWEEP_REPEAT_PENALTIES = (0.5, 1.0, 1.5, 2.0, 4.0, 8.0, 16.0)

#: What a text budget counts: up to 16 characters of a word, with the blanks before them.
UNIT = r"\s*\S{1,16}"
#: Parts of one key that are numbered in one place, on average.
PARTS_TOGETHER = 256

# Patterns of replies and contact records.
TRIPLE_PATTERN = r"^\s*\(([^,]+),([^,]+),(.+)\)\s*$"
EMAIL_PATTERN = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+"
PHONE_PATTERN = r"\+?[0-9][0-9 ()\-]{7,}[0-9]"
NAME_PATTERN = r"(?m)^\s*Name:\s*(.+?)\s*$"


def fill(template: str, text: Column) -> Column:
    """The template with its text slot filled."""
    if TEXT_SLOT not in template:
        raise ValueError(f"the template needs {TEXT_SLOT}")
    before, after = template.split(TEXT_SLOT, 1)
    return F.concat(F.lit(before), text, F.lit(after))


def prompt_requests(df: DataFrame, key: str, text: str, template: str, system: str = "") -> tuple[DataFrame, DataFrame]:
    """Requests ``(request_id, system, prompt, n_sources)``, one per distinct prompt, and links ``(request_id, key)``.

    Links are a table of their own: the sources of a prompt that a third of the rows share are never put in one row.
    """
    filled = df.where(F.col(text).isNotNull()).select(
        key, F.lit(system).alias("system"), fill(template, F.col(text)).alias("prompt")
    )
    filled = filled.withColumn("request_id", F.sha2(F.concat_ws("\n", "system", "prompt"), 256))
    requests = filled.groupBy("request_id", "system", "prompt").agg(F.count(F.lit(1)).alias("n_sources"))
    return requests, filled.select("request_id", key)


def attach_responses(links: DataFrame, responses: DataFrame) -> DataFrame:
    """Each source row with its reply; null while there is none."""
    return links.join(responses.select("request_id", "response"), "request_id", "left")


def parse_triples(responses: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Reply lines to ``(key, head, relation, tail, n)`` and to rejected lines ``(key, line)``.

    The third part keeps its commas. Blank lines are neither.
    """
    lines = unroll(responses, [key], F.split("response", r"\r?\n"), "line").where(F.col("line").rlike(r"\S"))
    fits = F.col("line").rlike(TRIPLE_PATTERN)
    part = lambda i: F.trim(F.regexp_extract("line", TRIPLE_PATTERN, i))
    good = lines.where(fits).select(key, part(1).alias("head"), part(2).alias("relation"), part(3).alias("tail"))
    whole = good.where((F.col("head") != "") & (F.col("relation") != "") & (F.col("tail") != ""))
    triples = whole.groupBy(key, "head", "relation", "tail").agg(F.count(F.lit(1)).alias("n"))
    empty_part = fits & ((part(1) == "") | (part(2) == "") | (part(3) == ""))
    return triples, lines.where(~fits | empty_part).select(key, "line")


def resolution_requests(groups: DataFrame, max_names: int = 200) -> tuple[DataFrame, DataFrame]:
    """Requests that ask which names of a candidate group are one thing, and links ``(request_id, group_id)``.

    ``groups`` has one row ``(group_id, entity_id)`` per name. A group of more than ``max_names`` names is asked in parts;
    names that agree without case, punctuation and spaces share a part.
    """
    sizes = groups.groupBy("group_id").agg(F.ceil(F.count(F.lit(1)) / max_names).alias("_parts"))
    form = F.regexp_replace(F.lower("entity_id"), r"[^\p{L}\p{N}]", "")
    placed = groups.join(sizes, "group_id").withColumn("part", F.pmod(F.xxhash64(form), F.col("_parts")))
    lists = placed.groupBy("group_id", "part").agg(F.array_sort(F.collect_set("entity_id")).alias("names"))
    asked = lists.where(F.size("names") > 1).select("group_id", F.array_join("names", "\n").alias("text"))
    return prompt_requests(asked, "group_id", "text", RESOLUTION_TEMPLATE, RESOLUTION_SYSTEM)


def parse_resolution(replies: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replies ``(request_id, group_id, response)`` to decisions ``(group_id, entity_id)`` and rejects of the same form as the replies.

    A reply is a JSON list of lists of names to merge, prose around it is passed over. Null, blank and empty lists mean no
    merge; text without such a list is rejected. Names that the candidate group does not hold are left out, and
    lists of fewer than two names say nothing. A decision's group is named by candidate group and smallest name.
    """
    body = F.regexp_extract("response", r"(?s)\[.*\]", 0)
    read = replies.where(F.col("response").rlike(r"\S")).withColumn("_lists", F.from_json(body, "array<array<string>>"))
    rejects = read.where(F.col("_lists").isNull()).select("request_id", "group_id", "response")
    merges = read.select("request_id", "group_id", F.posexplode("_lists").alias("_place", "_names"))
    named = merges.select("request_id", "group_id", "_place", F.explode(F.array_distinct("_names")).alias("entity_id"))
    known = named.join(groups.select("group_id", "entity_id").distinct(), ["group_id", "entity_id"], "left_semi")
    lists = known.groupBy("request_id", "group_id", "_place").agg(F.min("entity_id").alias("_lead"), F.count(F.lit(1)).alias("_n"))
    kept = known.join(lists.where(F.col("_n") > 1), ["request_id", "group_id", "_place"])
    return kept.select(F.concat_ws("|", F.col("group_id").cast("string"), "_lead").alias("group_id"), "entity_id").distinct(), rejects


def units(text: Column) -> Column:
    """The units of a text that a budget counts."""
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def budgeted_parts(rows: DataFrame, key: str, place: str, text: str, budget: int) -> DataFrame:
    """``(key, part, text)``: the texts of each key, by ``place``, in parts of fewer than ``budget`` units.

    A text of over a quarter of the budget is cut between units. A text goes to the part in which it starts, and parts
    start three quarters of the budget apart, so none overflows and no text waits for another. The running sum of a key
    with very many texts is taken in blocks by a hash of ``place``, never by one task. Null and blank texts give nothing,
    nor does an empty table; texts of one place come in the order of their characters.
    """
    limit = budget // 4
    if limit < 1:
        raise ValueError("a budget has at least 4 units")
    cut = rows.select(key, F.col(place).cast("string").alias("_place"), units(F.col(text)).alias("_units")).where(F.size("_units") > 0)
    pieces = F.transform(
        F.sequence(F.lit(0), F.size("_units") - 1, F.lit(limit)),
        lambda i: F.struct(F.array_join(F.slice("_units", i + 1, limit), "").alias("text"), F.least(F.lit(limit), F.size("_units") - i).alias("_n")),
    )
    cut = cut.select(key, "_place", F.posexplode(pieces).alias("_piece", "_row")).select(key, "_place", "_piece", "_row.*")
    blocks = cut.groupBy(key).agg(F.ceil(F.sum("_n") / (PARTS_TOGETHER * budget)).alias("_blocks"))
    digest = F.md5(F.concat_ws("|", "_place", F.col("_piece").cast("string")))
    placed = cut.join(blocks, key).withColumn("_block", F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col("_blocks"))
    before = Window.partitionBy(key, "_block").orderBy("_place", "_piece", "text").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0))
    part = F.shiftleft("_block", 32) + F.floor(start / (budget - limit)).cast("long")
    listed = placed.withColumn("part", part).groupBy(key, "part").agg(F.array_sort(F.collect_list(F.struct("_place", "_piece", "text"))).alias("_rows"))
    return listed.select(key, "part", F.array_join(F.transform("_rows", lambda r: r["text"]), "\n").alias("text"))


def reduce_texts(
    rows: DataFrame, key: str, place: str, text: str, budget: int, answer: Callable[[DataFrame], DataFrame],
    template: str = SUMMARY_TEMPLATE, system: str = SUMMARY_SYSTEM,
) -> DataFrame:
    """``(key, summary, rounds)``: one reply for each key, however long its texts are.

    ``answer`` takes the requests of a round and gives ``(request_id, response)``; it is called once a round and its
    replies are written. A key with one part has its summary; the replies to several parts, cut to a quarter of the budget,
    are the texts of the next round. Each round leaves about a third of the parts, so the rounds grow with the logarithm
    of the longest key. Replies that are missing or blank are left out; a key without any reply has a null summary.
    """
    limit = budget // 4
    parts, done = materialize(budgeted_parts(rows, key, place, text, budget)), []
    while True:
        asked = parts.select(F.struct(key, "part").alias("source"), "text")
        requests, links = prompt_requests(asked, "source", "text", template, system)
        told = materialize(attach_responses(links, answer(requests)).select("source.*", "response"))
        counts = told.groupBy(key).agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(F.col("response").rlike(r"\S")).alias("_told"), F.max("response").alias("summary")
        )
        over = (F.col("_n") == 1) | (F.col("_told") == 0)
        done.append(counts.where(over).select(key, F.when(F.col("_told") > 0, F.col("summary")).alias("summary"), F.lit(len(done)).alias("rounds")))
        rest = told.join(counts.where(~over).select(key), key, "left_semi")
        parts = materialize(budgeted_parts(
            rest.withColumn("response", F.array_join(F.slice(units(F.col("response")), 1, limit), "")), key, "part", "response", budget
        ))
        if parts.isEmpty():
            return reduce(DataFrame.unionByName, done)


def contact_fields(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, name, emails, phones)`` of texts that hold at least one e-mail address, phone number or name line."""
    found = df.select(
        key,
        F.nullif(F.regexp_extract(text, NAME_PATTERN, 1), F.lit("")).alias("name"),
        F.regexp_extract_all(text, F.lit(EMAIL_PATTERN), F.lit(0)).alias("emails"),
        F.regexp_extract_all(text, F.lit(PHONE_PATTERN), F.lit(0)).alias("phones"),
    )
    return found.where(F.col("name").isNotNull() | (F.size("emails") > 0) | (F.size("phones") > 0))


def parameter_sweep(
    requests: DataFrame,
    temperatures: tuple[float, ...] = SWEEP_TEMPERATURES,
    repeat_penalties: tuple[float, ...] = SWEEP_REPEAT_PENALTIES,
) -> DataFrame:
    """Every request once per setting. The grid is unrolled inside the row: no join."""
    grid = [
        F.struct(F.lit(t).alias("temperature"), F.lit(p).alias("repeat_penalty"))
        for t in temperatures
        for p in repeat_penalties
    ]
    swept = requests.select("request_id", "prompt", F.inline(F.array(*grid)))
    run = F.sha2(
        F.concat_ws("|", "request_id", F.col("temperature").cast("string"), F.col("repeat_penalty").cast("string")), 256
    )
    return swept.select(run.alias("run_id"), "request_id", "prompt", "temperature", "repeat_penalty")
