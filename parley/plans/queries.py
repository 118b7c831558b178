"""Registered queries: one per SURVEY §2 operator, each ``(spark, sf_dir) -> DataFrame``.

Each query reads the given tables (or inputs Spark derives from them row for
row, see ``parley.sources.fixtures``), runs the operator over all rows, and
returns flat columns whose names match ``parley.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.text import strip_ws
from parley.operators import chat_session as cs
from parley.operators import curate, evaluate, runlog, split, template
from parley.operators.normalize import accepted, explode_messages, normalize_rows, rejects, role_alias
from parley.session import input_key, materialize, prepare, work_dir
from parley.sources import fixtures as fx
from parley.sources import jsonl, manifest

# --- fixed values (query parameters) -----------------------------------------
KEYWORDS = fx.KEYWORDS                      # ["ung"], case-sensitive
KEYWORDS_CI = ["UNG"]                       # matched lower-cased
MULT_RULES = fx.MULTIPLIER_RULES            # [("identity", 2)]
CATEGORY_MULT = {"identity": 2}
SEED = fx.SEED
SELECT_FOLDER = "runs/src2"
IDENTITY_PATH = "runs/src0/fr/0.jsonl"
SKILLS_DIR = "runs/src4"
IGNORE_PATTERNS = ["checkpoint-*", "*.pyc", "runs/*", "optimizer.pt", "scheduler.pt", "rng_state.pth", "*.tmp"]
IGNORE_RELATIVE_TO = "runs/[^/]+/[^/]+/"
ALLOW_PATTERN = "runs/src2/*"
REROOT_PREFIX = "runs/src2/"
MUST = ["the", "ung"]
MUST_NOT = ["Ung"]
PASS_EVERY = 2
MAX_LEN = 256
SYSTEM_PROMPT = "You are a helpful assistant."
# -----------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]
MARKER_TOKENS = ["<|im_start|>", "assistant"]


# ---- shared building blocks ---------------------------------------------------

def _normalized(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    prepare(spark)
    return normalize_rows(fx.raw_lines(spark, sf_dir), keep_fields={"conv_id": "bigint"}, **kw)


def _with_id(df: DataFrame) -> DataFrame:
    """conv_id from the parsed row, or read from the raw text for broken lines."""
    return df.withColumn("conv_id", F.coalesce(F.col("conv_id"), fx.line_conv_id(F.col("value"))))


def _prep_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell-5 flow up to the keyword flag: normalise → multiplier → oversample → flag."""
    ok = accepted(_normalized(spark, sf_dir)).withColumn("mult", curate.multiplier_expr("file", MULT_RULES))
    return curate.keyword_flag(curate.oversample(ok), KEYWORDS)


def _coverage(spark, sf_dir):
    return curate.keyword_coverage(_prep_rows(spark, sf_dir))


def _conv_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(conv_id, messages)`` straight from the conversations table (turn order)."""
    conv = fx.table(spark, sf_dir, "conversations")
    per = conv.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    return per.select("conv_id", F.transform("t", lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("content"))).alias("messages"))


def _flagged_convs(spark, sf_dir):
    return curate.keyword_flag(_conv_messages(spark, sf_dir), KEYWORDS)


def _msg_rows(df: DataFrame) -> DataFrame:
    return explode_messages(df, keep=["conv_id"]).withColumn("pos", F.col("pos").cast("bigint"))


def _rendered(spark, sf_dir):
    m = _conv_messages(spark, sf_dir)
    first_a = F.try_element_at(F.filter("messages", lambda x: x["role"] == "assistant"), F.lit(1))["content"]
    return m.select("conv_id", "messages", template.render_chat("messages").alias("text"),
                    first_a.alias("first_response"))


def _tokens(spark, sf_dir):
    r = _rendered(spark, sf_dir)
    return r.withColumn("tokens", template.tokenize_simple("text"))


def _marker():
    return F.array(*[F.lit(t) for t in MARKER_TOKENS])


# ---- S: manifests, scans, sinks ----------------------------------------------

def q_manifest_select(spark, sf_dir):
    return manifest.select_files(fx.manifest(spark, sf_dir), SELECT_FOLDER, ".jsonl").select("path")


def q_manifest_category(spark, sf_dir):
    return manifest.tag_categories(fx.manifest(spark, sf_dir), IDENTITY_PATH, SKILLS_DIR).select("path", "category")


def q_manifest_ext_counts(spark, sf_dir):
    return manifest.ext_counts(fx.manifest(spark, sf_dir))


def q_manifest_ignore(spark, sf_dir):
    return manifest.filter_globs(fx.manifest(spark, sf_dir), IGNORE_PATTERNS, keep=False,
                                 relative_to=IGNORE_RELATIVE_TO).select("path")


def q_manifest_allow(spark, sf_dir):
    return manifest.filter_globs(fx.manifest(spark, sf_dir), [ALLOW_PATTERN], keep=True).select("path")


def q_manifest_reroot(spark, sf_dir):
    return manifest.reroot(fx.manifest(spark, sf_dir), REROOT_PREFIX).where("moved").select("path", "new_path")


def q_manifest_conflicts(spark, sf_dir):
    return manifest.reroot_conflicts(manifest.reroot(fx.manifest(spark, sf_dir), REROOT_PREFIX))


def q_manifest_list_files(spark, sf_dir):
    """S1 on storage: every file under a root with its length, an empty and a hidden one included."""
    root = fx.conversation_files(spark, sf_dir)
    files = manifest.list_files(spark, root, glob="*.txt")
    return files.select(F.regexp_extract("path", "/([^/]+)/[^/]+$", 1).alias("folder"), "length",
                        F.col("modificationTime").isNotNull().alias("timed"))


def q_jsonl_scan(spark, sf_dir):
    root = jsonl.materialize_raw_lines(spark, sf_dir)
    lines = jsonl.read_jsonl_lines(spark, root, glob=None, recursive=False, file_col="file")
    return lines.where(strip_ws("value") != "").select("file", fx.line_conv_id(F.col("value")).alias("conv_id"))


def q_normalize_reject_lines(spark, sf_dir):
    """P6 with S5: reject reason, logical file and 1-based line number, from files on disk."""
    root = jsonl.materialize_raw_lines(spark, sf_dir)
    lines = jsonl.read_jsonl_lines(spark, root, glob=None, recursive=False, file_col="file")
    numbered = jsonl.logical_line_numbers(lines)
    prepare(spark)
    return rejects(normalize_rows(numbered)).select("file", F.col("line_no").cast("bigint").alias("line_no"),
                                                    "outcome")


def q_jsonl_rejects(spark, sf_dir):
    n = _with_id(_normalized(spark, sf_dir))
    return n.where(F.col("outcome") == "json_error").select("file", "conv_id")


def _sink_path(spark, sf_dir):
    return work_dir(spark, "train_jsonl", input_key(sf_dir), uuid.uuid4().hex[:12])  # a new folder per call


def _write_train(spark, sf_dir) -> str:
    rows = curate.seeded_shuffle(_prep_rows(spark, sf_dir), SEED, ["conv_id", "replica"])
    return jsonl.write_training_jsonl(rows, _sink_path(spark, sf_dir))


def q_train_sink(spark, sf_dir):
    path = _write_train(spark, sf_dir)
    back = spark.read.text(path)
    parsed = back.select(F.size(F.from_json("value", "messages array<struct<role:string,content:string>>")
                                ["messages"]).alias("n_messages"))
    return parsed.groupBy(F.col("n_messages").cast("bigint").alias("n_messages")).agg(
        F.count(F.lit(1)).alias("n_rows"))


def q_train_reload(spark, sf_dir):
    path = _write_train(spark, sf_dir)
    back = jsonl.read_prepared(spark, path)
    return back.select(F.explode("messages").alias("m")).groupBy(F.col("m.role").alias("role")).agg(
        F.count(F.lit(1)).alias("n"))


def q_train_coverage_guard(spark, sf_dir):
    """Training-side check: strict re-read of the prepared file, keyword share, warn below 5 %."""
    back = jsonl.read_prepared(spark, _write_train(spark, sf_dir))
    cov = curate.keyword_coverage(curate.keyword_flag(back, KEYWORDS))
    return cov.withColumn("verdict", curate.soft_verdict("pct", curate.TRAIN_GUARD_MIN_PCT))


def q_guarded_sink(spark, sf_dir):
    """Write, audit and publish: rows published, or none where the share is outside the band."""
    path = _sink_path(spark, sf_dir)
    try:
        curate.guarded_write(_prep_rows(spark, sf_dir), path, jsonl.write_training_jsonl, SEED, ["conv_id", "replica"])
    except curate.GuardError:
        return spark.range(1).select(F.lit(False).alias("written"), F.lit(0).cast("bigint").alias("n_rows"))
    return jsonl.read_prepared(spark, curate.published(spark, path)).agg(
        F.lit(True).alias("written"), F.count(F.lit(1)).alias("n_rows"))


def q_marker_roundtrip(spark, sf_dir):
    r = _rendered(spark, sf_dir).select("conv_id", template.marker_tail("text", "first_response", 3).alias("ids"))
    path = work_dir(spark, "marker_ids", input_key(sf_dir), uuid.uuid4().hex[:12])
    jsonl.write_json_arrays(r, path)
    back = jsonl.read_json_arrays(spark, path, "conv_id bigint, ids array<string>")
    return back.select("conv_id", F.posexplode("ids").alias("pos", "token")).withColumn(
        "pos", F.col("pos").cast("bigint"))


# ---- P: normalisation -----------------------------------------------------------

def q_normalize_rows(spark, sf_dir):
    return _msg_rows(accepted(_normalized(spark, sf_dir)))


def _norm_shape(shape):
    def q(spark, sf_dir):
        return _msg_rows(accepted(_normalized(spark, sf_dir)).where(F.col("shape") == shape))
    return q


def q_normalize_messages_only(spark, sf_dir):
    n = _with_id(_normalized(spark, sf_dir, shapes=("messages",), lazy_content_check=True))
    return n.select("conv_id", "outcome")


def q_normalize_outcome_counts(spark, sf_dir):
    """Every outcome counted per file (json errors included)."""
    from parley.operators.normalize import outcome_counts

    return outcome_counts(_normalized(spark, sf_dir), by=["file"])


def q_normalize_rejects(spark, sf_dir):
    return rejects(_with_id(_normalized(spark, sf_dir))).select("conv_id", "outcome")


_ALIAS_WRITTEN = {"user": " Human", "assistant": "GPT ", "system": "SYSTEM"}


def q_role_alias(spark, sf_dir):
    conv = fx.table(spark, sf_dir, "conversations")
    written = F.create_map(*[F.lit(x) for kv in _ALIAS_WRITTEN.items() for x in kv])
    return conv.select("conv_id", "turn", role_alias(F.element_at(written, F.col("role"))).alias("role"))


def q_strip_ws(spark, sf_dir):
    conv = fx.table(spark, sf_dir, "conversations")
    padded = F.concat(F.lit("\u00a0\t "), F.col("text"), F.lit(" \u3000\n\u2028"))
    return conv.select("conv_id", "turn", strip_ws(padded).alias("text"))


# ---- K: keywords -----------------------------------------------------------------

def q_keyword_flag(spark, sf_dir):
    return _flagged_convs(spark, sf_dir).select("conv_id", "flag")


def q_keyword_flag_ci(spark, sf_dir):
    return curate.keyword_flag(_conv_messages(spark, sf_dir), KEYWORDS_CI, case_sensitive=False).select(
        "conv_id", "flag")


# ---- J/U/O/A/G/L: curation -----------------------------------------------------------

def q_file_multiplier(spark, sf_dir):
    files = fx.raw_lines(spark, sf_dir).select("file").distinct()
    return curate.file_multiplier(files, MULT_RULES).withColumn("mult", F.col("mult").cast("bigint"))


def q_category_multiplier(spark, sf_dir):
    files = fx.raw_lines(spark, sf_dir).select("file").distinct()
    cat = F.when(F.col("file") == fx.IDENTITY_FILE, F.lit("identity")).otherwise(F.lit("skills"))
    return files.select("file", cat.alias("category")).withColumn(
        "mult", curate.category_multiplier("category", CATEGORY_MULT).cast("bigint"))


def q_union_files(spark, sf_dir):
    """The rows of every file that is there (bag union), in one scan, normalised once."""
    root = jsonl.materialize_raw_lines(spark, sf_dir)
    lines = jsonl.read_jsonl_lines(spark, root, glob=None, recursive=False, file_col="file")
    u = accepted(normalize_rows(lines, keep_fields={"conv_id": "bigint"}))
    return u.select("file", "conv_id", F.size("messages").cast("bigint").alias("n_messages"))


def q_oversample(spark, sf_dir):
    return _prep_rows(spark, sf_dir).select("conv_id", F.col("replica").cast("bigint").alias("replica"))


def q_file_stats(spark, sf_dir):
    n = _normalized(spark, sf_dir).withColumn("mult", curate.multiplier_expr("file", MULT_RULES))
    return curate.file_stats(n)


def q_keyword_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir)


def q_coverage_soft_guard(spark, sf_dir):
    return curate.soft_guard(_coverage(spark, sf_dir))


def q_coverage_band_guard(spark, sf_dir):
    return curate.band_guard(_coverage(spark, sf_dir))


def q_prep_summary(spark, sf_dir):
    return curate.prep_summary(_coverage(spark, sf_dir))


def q_step_plan(spark, sf_dir):
    f = materialize(_flagged_convs(spark, sf_dir).select("conv_id", "flag"), "split_keys")   # for both profiles
    out = None
    for prof in ("A", "B"):
        micro, accum, epochs, floor = split.PROFILES[prof]
        s = split.stratified_split(f, "flag", ["conv_id"], seed=SEED, quota=prof, materialize_input=False)
        n = s.where(F.col("split") == "train").agg(F.count(F.lit(1)).alias("n_train"))
        row = n.select(F.lit(prof).alias("profile"), "n_train",
                       *curate.step_plan("n_train", micro, accum, epochs, floor))
        out = row if out is None else out.unionByName(row)
    return out


# ---- O2 / X: shuffle and split -----------------------------------------------------------

def q_seeded_shuffle(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return curate.seeded_shuffle(ids, SEED, ["conv_id"], rank_col="rank")


def _split_q(prof):
    def q(spark, sf_dir):
        s = split.stratified_split(_flagged_convs(spark, sf_dir), "flag", ["conv_id"], seed=SEED, quota=prof)
        return s.select("conv_id", "split")
    return q


def q_split_summary(spark, sf_dir):
    s = split.stratified_split(_flagged_convs(spark, sf_dir), "flag", ["conv_id"], seed=SEED, quota="A")
    return split.split_summary(s, "flag")


def q_split_leak_safe(spark, sf_dir):
    rows = _prep_rows(spark, sf_dir)
    s = split.leak_safe_split(rows, "flag", seed=SEED, quota="A", order_col="conv_id")
    return s.select("conv_id", F.col("replica").cast("bigint").alias("replica"), "split")


def q_split_leak_report(spark, sf_dir):
    rows = materialize(_prep_rows(spark, sf_dir).select("conv_id", "replica", "flag", split.content_key().alias(
        "_group")), "split_keys")
    compat = split.stratified_split(rows, "flag", ["conv_id", "replica"], seed=SEED, quota="A",
                                    materialize_input=False)
    safe = split.leak_safe_split(rows, "flag", seed=SEED, quota="A", order_col="conv_id", materialize_input=False)
    a = split.leak_report(compat, "_group").select(F.lit("compat").alias("mode"), "n_leaked")
    b = split.leak_report(safe, "_group").select(F.lit("leak_safe").alias("mode"), "n_leaked")
    return a.unionByName(b)


# ---- T: template, tokens, mask ----------------------------------------------------------

def q_render_chat(spark, sf_dir):
    return _rendered(spark, sf_dir).select("conv_id", "text")


def _assistant_turns(spark, sf_dir):
    """``(conv_id, turn, before, reply)``: one row per assistant turn with the messages before it."""
    conv = fx.table(spark, sf_dir, "conversations")
    per = conv.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    per = per.withColumn("m", F.transform("t", lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("content"))))
    one = per.select("conv_id", "m", F.posexplode("t").alias("i", "x"))
    return one.where(F.col("x.role") == "assistant").select(
        "conv_id", "x.turn", F.slice("m", 1, F.col("i")).alias("before"),
        F.slice("m", F.col("i") + 1, 1).alias("reply"))


def q_render_prompt(spark, sf_dir):
    return _assistant_turns(spark, sf_dir).select(
        "conv_id", "turn", template.render_chat("before", add_generation_prompt=True).alias("prompt"))


def q_marker_check(spark, sf_dir):
    r = _rendered(spark, sf_dir)
    return r.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(template.marker_missing("text")).alias("n_missing"))


def q_tokenize_simple(spark, sf_dir):
    t = _tokens(spark, sf_dir)
    return t.select("conv_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens_text"))


def q_array_find_subseq(spark, sf_dir):
    t = _tokens(spark, sf_dir)
    return t.select("conv_id", template.find_subseq("tokens", _marker()).cast("bigint").alias("pos"),
                    template.find_subseq("tokens", _marker(), last=True).cast("bigint").alias("last_pos"))


def q_marker_tail(spark, sf_dir):
    r = _rendered(spark, sf_dir)
    return r.select("conv_id",
                    F.array_join(template.marker_tail("text", "first_response", 3), " ").alias("tail3"),
                    F.array_join(template.marker_tail("text", "first_response", 5), " ").alias("tail5"))


def _masked(spark, sf_dir):
    t = _tokens(spark, sf_dir).withColumn("mask_start", template.mask_start("tokens", _marker()))
    return t.withColumn("labels", template.masked_labels("tokens", "mask_start"))


def q_completion_mask(spark, sf_dir):
    m = _masked(spark, sf_dir)
    return m.select("conv_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.col("mask_start").cast("bigint").alias("mask_start"),
                    F.size(F.filter("labels", lambda x: x.isNotNull())).cast("bigint").alias("n_trained"))


def q_marker_mismatch(spark, sf_dir):
    """Marker occurrences vs assistant turns per conversation (a marker inside other text shifts the mask)."""
    t = _tokens(spark, sf_dir)
    n_asst = F.size(F.filter("messages", lambda m: m["role"] == "assistant"))
    out = t.select("conv_id", template.count_subseq("tokens", _marker()).cast("bigint").alias("n_markers"),
                   n_asst.cast("bigint").alias("n_assistant"))
    return out.withColumn("mismatch", F.col("n_markers") != F.col("n_assistant"))


def q_completion_mask_all(spark, sf_dir):
    """T7 ``all_assistant``: trained tokens are every assistant turn's content and its end token."""
    t = template.with_assistant_labels(_tokens(spark, sf_dir), "tokens", _marker())
    return t.select("conv_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                    F.size(F.filter("labels", lambda x: x.isNotNull())).cast("bigint").alias("n_trained"))


def q_truncate_tokens(spark, sf_dir):
    t = _tokens(spark, sf_dir).withColumn("cut", template.truncate_tokens("tokens", MAX_LEN))
    return t.select("conv_id", F.size("cut").cast("bigint").alias("n_kept"),
                    F.try_element_at("cut", F.lit(-1)).alias("last_token"))


def q_truncation_report(spark, sf_dir):
    m = _masked(spark, sf_dir)
    return m.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.size("tokens") > MAX_LEN).alias("n_truncated"),
                 F.count_if(F.col("mask_start").isNull() | (F.col("mask_start") >= MAX_LEN)).alias("n_response_cut"))


def q_strip_prompt(spark, sf_dir):
    rows = template.strip_prompts(fx.table(spark, sf_dir, "conversations"))
    return rows.select("conv_id", "turn", "n_prompt", F.size("generated").cast("bigint").alias("n_generated"),
                       F.array_join("generated", " ").alias("generated"))


def tokenizer_file(spark: SparkSession, name: str) -> str:
    """A public tokenizer file, sent to the executors; its folder is a setting (``parley.tokenizers``)."""
    return template.ship_file(spark, f"{spark.conf.get('parley.tokenizers', '/opt/tokenizers')}/{name}")


def _subword_labels(spark, sf_dir, **kw):
    name = tokenizer_file(spark, "byte_bpe_50k.json")
    return name, template.label_tokens(_conv_messages(spark, sf_dir), template.tokenizers_file(name), **kw)


def _decoder(name):
    def make():
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(template.shipped(name))
        return lambda ids: tok.decode(ids, skip_special_tokens=False)

    return make


def q_subword_mask(spark, sf_dir):
    """T7 with a real subword vocabulary: the text of the trained tokens, decoded from their ids."""
    name, rows = _subword_labels(spark, sf_dir)
    trained = F.filter("labels", lambda x: x != template.IGNORE_INDEX)
    return rows.select("conv_id", template.decode_with(trained, _decoder(name)).alias("trained_text"),
                       (F.size("ids") == F.col("n_tokens")).alias("whole"))


def q_subword_mask_last(spark, sf_dir):
    """T7, completion only: the text after the last assistant header."""
    name, rows = _subword_labels(spark, sf_dir, mode="last")
    trained = F.filter("labels", lambda x: x != template.IGNORE_INDEX)
    return rows.select("conv_id", template.decode_with(trained, _decoder(name)).alias("trained_text"))


def _byte_encoder():
    return lambda text: text.encode("utf-8")


def _byte_decoder():
    return lambda ids: bytes(ids).decode("utf-8", "replace")


def q_decode_tokens(spark, sf_dir):
    """T9 both ways with a plugged-in tokenizer (UTF-8 bytes as ids): decode(encode(text)) is the text."""
    conv = fx.table(spark, sf_dir, "conversations")
    ids = conv.select("conv_id", "turn", template.tokenize_with("text", _byte_encoder).alias("ids"))
    return ids.select("conv_id", "turn", template.decode_with("ids", _byte_decoder).alias("decoded"),
                      F.size("ids").cast("bigint").alias("n_ids"))


def q_marker_choice(spark, sf_dir):
    t = _tokens(spark, sf_dir)
    return t.select("conv_id", F.array_join(
        template.marker_choice("tokens", _marker(), "text", "first_response"), " ").alias("marker"))


# ---- E: evaluation -----------------------------------------------------------------------------

def _scored(spark, sf_dir):
    return evaluate.response_pass(fx.responses(spark, sf_dir), MUST, MUST_NOT)


def q_response_pass(spark, sf_dir):
    return _scored(spark, sf_dir).select("conv_id", "turn", "ok", "preview")


def q_response_pass_by_step(spark, sf_dir):
    return evaluate.pass_by_step(_scored(spark, sf_dir), PASS_EVERY)


# ---- M: run logs and checkpoints -----------------------------------------------------------------

def q_run_heartbeat(spark, sf_dir):
    return runlog.heartbeat(fx.run_log(spark, sf_dir), fx.HEARTBEAT_EVERY)


def q_run_peaks(spark, sf_dir):
    return runlog.peaks(fx.run_log(spark, sf_dir), fx.HEARTBEAT_EVERY)


def q_latest_checkpoint(spark, sf_dir):
    return runlog.latest_checkpoint(fx.checkpoints(spark, sf_dir))


def q_best_checkpoint(spark, sf_dir):
    return runlog.best_checkpoint(fx.checkpoints(spark, sf_dir))


def q_retain_checkpoints(spark, sf_dir):
    return runlog.retain_checkpoints(fx.checkpoints(spark, sf_dir))


# ---- H: chat sessions ----------------------------------------------------------------------------

def _epochs(spark, sf_dir):
    return cs.session_epochs(fx.session_turns(spark, sf_dir))


def q_session_commands(spark, sf_dir):
    return fx.session_turns(spark, sf_dir).select("conv_id", "turn", cs.command_kind().alias("kind"))


def q_session_epochs(spark, sf_dir):
    return _epochs(spark, sf_dir).select("conv_id", "turn", "kind", "epoch")


def _history_q(cap):
    def q(spark, sf_dir):
        return cs.session_history(_epochs(spark, sf_dir), cap).select("conv_id", "turn", "n_history",
                                                                       "history_turns")
    return q


def q_session_history_count(spark, sf_dir):
    return cs.history_count(_epochs(spark, sf_dir))


def q_session_prompt(spark, sf_dir):
    h = cs.session_history(_epochs(spark, sf_dir))
    return cs.session_prompt(h, SYSTEM_PROMPT).select("conv_id", "turn", "prompt")


def q_join_chunks(spark, sf_dir):
    return cs.join_chunks(fx.chunks(spark, sf_dir), ["conv_id", "turn"], sep=" ")


# ---- W: streaming -----------------------------------------------------------------------------------

def q_stream_session(spark, sf_dir):
    from parley.streaming.session_state import run_session_stream

    return run_session_stream(spark, sf_dir).select("conv_id", "turn", "n_history", "history_turns")


def q_stream_session_table(spark, sf_dir):
    from parley.streaming.session_table import run_session_table_stream

    return run_session_table_stream(spark, sf_dir).select("conv_id", "turn", "n_history", "history_turns")


def q_stream_normalize(spark, sf_dir):
    from parley.streaming.normalize_stream import run_normalize_stream

    return _msg_rows(run_normalize_stream(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "manifest_select": q_manifest_select,
    "manifest_category": q_manifest_category,
    "manifest_ext_counts": q_manifest_ext_counts,
    "manifest_ignore": q_manifest_ignore,
    "manifest_allow": q_manifest_allow,
    "manifest_reroot": q_manifest_reroot,
    "manifest_conflicts": q_manifest_conflicts,
    "manifest_list_files": q_manifest_list_files,
    "jsonl_scan": q_jsonl_scan,
    "jsonl_rejects": q_jsonl_rejects,
    "normalize_reject_lines": q_normalize_reject_lines,
    "train_coverage_guard": q_train_coverage_guard,
    "train_sink": q_train_sink,
    "train_reload": q_train_reload,
    "guarded_sink": q_guarded_sink,
    "marker_roundtrip": q_marker_roundtrip,
    "norm_messages": _norm_shape("messages"),
    "norm_conversation": _norm_shape("conversation"),
    "norm_instruction": _norm_shape("instruction"),
    "normalize_rows": q_normalize_rows,
    "normalize_messages_only": q_normalize_messages_only,
    "normalize_rejects": q_normalize_rejects,
    "normalize_outcome_counts": q_normalize_outcome_counts,
    "role_alias": q_role_alias,
    "strip_ws": q_strip_ws,
    "keyword_flag": q_keyword_flag,
    "keyword_flag_ci": q_keyword_flag_ci,
    "file_multiplier": q_file_multiplier,
    "category_multiplier": q_category_multiplier,
    "union_files": q_union_files,
    "oversample": q_oversample,
    "file_stats": q_file_stats,
    "keyword_coverage": q_keyword_coverage,
    "coverage_soft_guard": q_coverage_soft_guard,
    "coverage_band_guard": q_coverage_band_guard,
    "prep_summary": q_prep_summary,
    "step_plan": q_step_plan,
    "seeded_shuffle": q_seeded_shuffle,
    "split_profile_a": _split_q("A"),
    "split_profile_b": _split_q("B"),
    "split_summary": q_split_summary,
    "split_leak_safe": q_split_leak_safe,
    "split_leak_report": q_split_leak_report,
    "render_chat": q_render_chat,
    "render_prompt": q_render_prompt,
    "marker_check": q_marker_check,
    "tokenize_simple": q_tokenize_simple,
    "array_find_subseq": q_array_find_subseq,
    "marker_tail": q_marker_tail,
    "completion_mask": q_completion_mask,
    "completion_mask_all": q_completion_mask_all,
    "marker_mismatch": q_marker_mismatch,
    "truncate_tokens": q_truncate_tokens,
    "truncation_report": q_truncation_report,
    "strip_prompt": q_strip_prompt,
    "subword_mask": q_subword_mask,
    "subword_mask_last": q_subword_mask_last,
    "decode_tokens": q_decode_tokens,
    "marker_choice": q_marker_choice,
    "response_pass": q_response_pass,
    "response_pass_by_step": q_response_pass_by_step,
    "run_heartbeat": q_run_heartbeat,
    "run_peaks": q_run_peaks,
    "latest_checkpoint": q_latest_checkpoint,
    "best_checkpoint": q_best_checkpoint,
    "retain_checkpoints": q_retain_checkpoints,
    "session_commands": q_session_commands,
    "session_epochs": q_session_epochs,
    "session_history": _history_q(cs.HISTORY_CAP),
    "session_history_cap3": _history_q(3),
    "session_history_count": q_session_history_count,
    "session_prompt": q_session_prompt,
    "join_chunks": q_join_chunks,
    "stream_session": q_stream_session,
    "stream_session_table": q_stream_session_table,
    "stream_normalize": q_stream_normalize,
}
