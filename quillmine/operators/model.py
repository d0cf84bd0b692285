"""Map and reduce over sections of documents with a model that is a plain function from messages to text."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from quillmine.functions import grounding, nested
from quillmine.functions import text as T
from quillmine.functions.arrow import SLICE
from quillmine.operators import batching, sections
from quillmine.sources.shared import stored

Model = Callable[[list[dict[str, str]]], str]
SECTION_NAMES = tuple(sections.HANDLERS)


def map_prompts(paragraphs: DataFrame, budget: int, overlap: int, instructions: dict[str, str], contract: dict) -> DataFrame:
    """document_id, section, batch_id, targets, texts, prompt. paragraphs: document_id, paragraph_index, section,
    text. targets, texts: the batch's paragraphs, as bounded as the prompt.

    A section's paragraphs are batched under the token budget; a batch is led in by the ones before it as context."""
    handler = F.create_map(*[F.lit(x) for h, names in sections.HANDLERS.items() for n in names for x in (n, h)])
    rows = paragraphs.withColumn("section", F.try_element_at(handler, F.col("section"))).where("section is not null")
    block = T.paragraph_block(F.col("paragraph_index"), F.col("text"))
    grouped = rows.groupBy("document_id", "section").agg(F.array_sort(F.collect_list(F.struct("paragraph_index", block.alias("block"), T.token_count(block).alias("tokens"), "text"))).alias("all"))
    cut = grouped.select("*", F.inline(batching.batch_column(F.transform("all", lambda p: p["tokens"]), budget, overlap)))
    joined = lambda first, last: F.array_join(F.transform(F.slice("all", first, last - first + 1), lambda p: p["block"]), "\n")
    says = F.create_map(*[F.lit(x) for pair in instructions.items() for x in pair])
    prompt = F.concat(
        F.coalesce(F.try_element_at(says, F.col("section")), F.lit("")), F.lit("\n\nContract:\n" + json.dumps(contract, ensure_ascii=False, sort_keys=True)),
        F.when(F.col("context_from") < F.col("first"), F.concat(F.lit("\n\nContext:\n"), joined(F.col("context_from"), F.col("first") - 1))).otherwise(""), F.lit("\n\nTargets:\n"), joined(F.col("first"), F.col("last")),
    )
    return cut.select("document_id", "section", "batch_id", F.transform(F.slice("all", F.col("first"), F.col("last") - F.col("first") + 1), lambda p: p["paragraph_index"]).alias("targets"), F.transform(F.slice("all", F.col("first"), F.col("last") - F.col("first") + 1), lambda p: p["text"]).alias("texts"), prompt.alias("prompt"))


def answered(prompts: DataFrame, model: Model, retries: int = 1, context_tokens: int | None = None, most_new_tokens: int = 0, repair: Callable[[str], str | None] = nested.repair_object, keep_calls: bool = False) -> DataFrame:
    """H7, H8: prompts with answer, calls and error. An answer that is not a JSON object, also after the repair of one that
    ends as an object does, is asked for again, with what was wrong; a prompt that leaves no room in the context for
    most_new_tokens of answer is an error without a call. keep_calls adds attempts: what each call was asked, said and why that
    was not taken. Store the result before using it twice."""
    schema = prompts.schema.simpleString()[len("struct<") : -1]

    def read(answer: str) -> str:
        bare = strip_fence(answer)
        try:
            value = json.loads(bare)
        except ValueError:
            mended = repair(bare) if bare.endswith("}") else None
            if mended is None:
                raise
            value = json.loads(mended)
        if not isinstance(value, dict):
            raise TypeError("the answer must be an object")
        return json.dumps(value, ensure_ascii=False)

    def ask(prompt: str, size: int) -> tuple[str | None, int, str | None, list[dict]]:
        if context_tokens is not None and size + most_new_tokens > context_tokens:
            return None, 0, f"a prompt of {size} tokens and {most_new_tokens} of answer are beyond the context of {context_tokens}", []
        said, problem, attempts = prompt, None, []
        for call in range(1, retries + 2):
            response = None
            try:
                response = model([{"role": "user", "content": said}])
                found, problem = read(response), None
            except (TypeError, ValueError) as error:
                found, problem = None, str(error)
            attempts.append({"call": call, "request": said, "response": response, "error": problem})
            if problem is None:
                return found, call, None, attempts
            said = f"{prompt}\n\nThe last answer could not be used: {problem}"
        return None, retries + 1, problem, attempts

    attempt = pa.struct([("call", pa.int32()), ("request", pa.string()), ("response", pa.string()), ("error", pa.string())])
    added = {"answer": pa.string(), "calls": pa.int32(), "error": pa.string()} | ({"attempts": pa.list_(attempt)} if keep_calls else {})

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.drop_columns("_tokens")
            # only a slice's prompts and answers are Python objects at a time, and the other columns never are
            for k in range(0, len(batch), SLICE):
                part = batch.slice(k, SLICE)
                got = [ask(p, n) for p, n in zip(part.column("prompt").to_pylist(), part.column("_tokens").to_pylist())]
                new = [pa.array([g[i] for g in got], kind) for i, kind in enumerate(added.values())]
                yield pa.RecordBatch.from_arrays([*kept.slice(k, SLICE).columns, *new], names=[*kept.schema.names, *added])

    calls = ",attempts:array<struct<call:int,request:string,response:string,error:string>>" if keep_calls else ""
    return prompts.withColumn("_tokens", T.token_count(F.col("prompt"))).mapInArrow(go, f"struct<{schema},answer:string,calls:int,error:string{calls}>")


def call_artifacts(answers: DataFrame, keys: list[str]) -> DataFrame:
    """H7: name, content (JSON with sorted keys) of a file for each call, below a folder for its keys. answers: with attempts."""
    place = F.concat_ws("/", *[F.regexp_replace(F.col(k).cast("string"), r"[^\w.-]", "_") for k in keys])
    each = answers.select(place.alias("place"), F.inline("attempts"))
    name = F.concat(F.col("place"), F.format_string("/call-%03d.json", F.col("call")))
    return each.select(name.alias("name"), F.to_json(F.struct("call", "error", "request", "response"), {"ignoreNullFields": "false"}).alias("content"))


def strip_fence(answer: str) -> str:
    bare = answer.strip()
    if bare.startswith("```") and bare.endswith("```") and len(bare) >= 6:
        bare = bare[3:-3].strip()
        bare = bare[4:].strip() if bare[:4].lower() == "json" else bare
    return bare


def observations(answers: DataFrame, section: S.StructType, section_name: str) -> DataFrame:
    """The observations in map answers, one row each: document_id, section, batch_id, targets, texts, paragraph_index,
    source_quote, extraction."""
    schema = nested.observation_schema(section, section_name)
    batch = ["document_id", "section", "batch_id", "targets", "texts"]
    parsed = answers.where("answer is not null").select(*batch, F.from_json("answer", schema).alias("v"))
    return parsed.select(*batch, F.inline("v.observations")).select(*batch, "paragraph_index", "source_quote", F.col(f"extraction.{section_name}").alias("extraction"))


def map_reduce(paragraphs: DataFrame, section: S.StructType, section_name: str, map_model: Model, reduce_model: Model, budget: int = 6000, overlap: int = 256, instructions: dict[str, str] | None = None, **call) -> DataFrame:
    """H8, H9 for one section: document_id, map_calls, map_errors, kept, dropped, ungrounded, problems, result (JSON), errors.

    Observations are kept if they have content and are grounded in their paragraph, and so are the records in them; problems
    says what was wrong with the others. The kept ones of a document go to one reduce call, whose result must satisfy the
    section's schema and cite observed paragraphs only. A document without paragraphs of the section has no call and no
    result. Answers are written to the shared folder, so that no lost executor has the model asked twice."""
    prompts = map_prompts(paragraphs, budget, overlap, instructions or {}, nested.struct_contract(nested.observation_schema(section, section_name))).where(F.col("section") == section_name)
    answers = stored(answered(prompts, map_model, **call), "map-answers")
    found = observations(answers, section, section_name)
    checked = grounding.checked_observations(found, nested.has_content(F.col("extraction"), section), nested.citations(F.col("extraction"), section, F.lit(section_name)))
    fine, verdict = F.col("verdict") == "kept", F.col("verdict")
    per_doc = checked.groupBy("document_id").agg(
        F.count_if(fine).alias("kept"), F.count_if(verdict == "dropped").alias("dropped"), F.count_if(~verdict.isin("kept", "dropped")).alias("ungrounded"),
        F.transform(F.array_sort(F.collect_list(F.when(~verdict.isin("kept", "dropped"), F.struct("paragraph_index", "verdict")))), lambda x: F.concat(x["paragraph_index"].cast("string"), F.lit(": "), x["verdict"])).alias("problems"),
        F.array_sort(F.collect_set(F.when(fine, F.col("paragraph_index")))).alias("observed"),
        F.to_json(F.array_sort(F.collect_list(F.when(fine, F.struct("batch_id", "paragraph_index", "source_quote", F.to_json("extraction").alias("extraction")))))).alias("prompt"),
    )
    per_doc = stored(per_doc, "observed")
    calls = answers.groupBy("document_id").agg(F.sum("calls").alias("map_calls"), F.count("error").alias("map_errors"))
    reduced = stored(answered(per_doc.where("kept > 0").select("document_id", "observed", "prompt"), reduce_model, **(call | {"retries": 0})), "reduce-answers")
    checked_result = reduced.withColumn("check", nested.checked_payload(F.col("answer"), section))
    indexes = nested.paragraph_indexes(F.from_json("check.payload", section), section)
    foreign = F.transform(grounding.foreign_indexes(indexes, F.col("observed")), lambda i: F.concat(F.lit("paragraph not observed: "), i.cast("string")))
    none = F.array().cast("array<string>")
    errors = F.when(F.col("error").isNotNull(), F.array("error")).otherwise(F.concat(F.coalesce("check.errors", none), F.coalesce(foreign, none)))
    results = checked_result.select("document_id", F.col("check.payload").alias("result"), errors.alias("errors"))
    return calls.join(per_doc.select("document_id", "kept", "dropped", "ungrounded", "problems"), "document_id", "left").join(results, "document_id", "left")


def extraction_chain(paragraphs: DataFrame, parts: dict[str, tuple[str, S.StructType]], map_model: Model, reduce_model: Model, budget: int = 6000, overlap: int = 256, instructions: dict[str, str] | None = None, **call) -> DataFrame:
    """One row a document: document_id, text (its paragraphs by blank lines), a struct for each part, complete, errors.

    parts: section -> (result field, its schema); sections are taken in turn. A part whose result has errors, or that has
    none because observations were refused or calls failed, is null, and errors say why, led by the field's name; a document
    without paragraphs of a section has a null part and no error for it. complete: no part has errors."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("paragraph_index", "text"))), lambda p: p["text"]), "\n\n")
    out = paragraphs.groupBy("document_id").agg(text.alias("text"))
    none, fields, problems = F.array().cast("array<string>"), [], []
    for section, (field, schema) in parts.items():
        got = map_reduce(paragraphs, schema, section, map_model, reduce_model, budget, overlap, instructions, **call)
        wrong = F.concat(
            F.coalesce("errors", none), F.coalesce("problems", none),
            F.when(F.coalesce("map_errors", F.lit(0)) > 0, F.array(F.concat(F.col("map_errors").cast("string"), F.lit(" calls without an answer")))).otherwise(none),
        )
        got = got.select("document_id", F.when(F.size(F.coalesce("errors", none)) == 0, F.from_json("result", schema)).alias(field), F.transform(wrong, lambda e, name=field: F.concat(F.lit(f"{name}: "), e)).alias(f"_{field}"))
        out = out.join(got, "document_id", "left")
        fields.append(field)
        problems.append(F.coalesce(f"_{field}", none))
    errors = F.concat(none, *problems)
    return out.select("document_id", "text", *fields, (F.size(errors) == 0).alias("complete"), errors.alias("errors"))


def outcomes(prompts: DataFrame, model: Model, **call) -> DataFrame:
    """A plain call for each document: document_id, status (success or error), result, error."""
    got = answered(prompts.select("document_id", "prompt"), model, **call)
    return got.select("document_id", F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"), F.col("answer").alias("result"), "error")


def anchor_report(results: DataFrame, schema: S.StructType, anchors: DataFrame) -> DataFrame:
    """Anchors (document_id, article, paths) with found_article, missing_paths and passed: whether a document's result
    (a struct column `result`) names the article somewhere and has content at all the paths. A document without a result does
    not pass; without anchors there are no rows."""
    filled = [(path, nested.has_content(*nested.at_path(F.col("result"), schema, path))) for path, _, _ in nested.leaves(schema) if "[]" not in path]
    present = F.filter(F.array(*[F.when(has, F.lit(path)) for path, has in filled]), lambda x: x.isNotNull())
    rows = anchors.join(results.select("document_id", "result"), "document_id", "left")
    rows = rows.withColumn("found_article", nested.has_equal(F.col("result"), schema, "article", F.col("article"))).withColumn("missing_paths", F.array_except("paths", present))
    return rows.select("document_id", "article", "found_article", "missing_paths", (F.col("found_article") & (F.size("missing_paths") == 0)).alias("passed"))


def side_output(paragraphs: DataFrame, names: tuple[str, ...], prompt: str, schema: S.StructType, model: Model) -> DataFrame:
    """One more prompt over chosen sections, whose checked answers stay outside the extraction."""
    rows = paragraphs.where(F.col("section").isin(*names))
    block = T.paragraph_block(F.col("paragraph_index"), F.col("text"))
    prompts = rows.groupBy("document_id").agg(F.concat(F.lit(prompt + "\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("paragraph_index", block.alias("b")))), lambda p: p["b"]), "\n")).alias("prompt"))
    return answered(prompts, model).withColumn("check", nested.checked_payload(F.col("answer"), schema)).select("document_id", "check.payload", "check.errors")
