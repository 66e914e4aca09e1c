"""Section text to overlapping word windows and to model requests.

``sections``: rel_path STRING, text STRING. ``chunks``: rel_path, chunk_index INT (from 1),
n_chunks INT, chunk STRING. ``progress``: rel_path STRING, done INT.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bind, strip, word_windows

# Window sizes, thresholds and request settings.
FIXED_WORDS = 800
FIXED_OVERLAP = 150
SAFE_RATIO = 0.8
TOKENS_PER_WORD = 1.3
LEAST_TARGET_WORDS = 500
OVERLAP_RATIO = 0.1
MIN_CHUNK_CHARS = 50
TEMPERATURE = 0.3
EARLY_MAX_TOKENS = 8192

# Our own wording; pass another as ``prompt``.
PROMPT = (
    "Write question and answer pairs for training from the user's text. Answer with nothing but "
    "a JSON array of 6 to 8 objects with the keys instruction, input and output. Keep every value "
    "on one line. Phrase each instruction as a question or as a command."
)
EARLY_PROMPT = (
    "Write question and answer pairs for training from the user's text. Answer with nothing but "
    "a JSON array of 8 to 10 objects with the keys instruction, input (may be empty) and output."
)


@dataclass(frozen=True)
class Budget:
    """Token and word limits that follow from a model's context length."""

    safe_tokens: int
    target: int
    overlap: int


def token_budget(max_context: int, ratio: float = SAFE_RATIO) -> Budget:
    """Window size for a context. A text's length has no say: the target is the same for all."""
    safe = int(max_context * ratio)
    target = max(LEAST_TARGET_WORDS, int(safe / TOKENS_PER_WORD))
    return Budget(safe, target, int(target * OVERLAP_RATIO))


def with_token_budget(models: DataFrame, ratio: float = SAFE_RATIO) -> DataFrame:
    """The same per row, for a table of models with a ``max_context`` column."""
    safe = (F.col("max_context") * F.lit(float(ratio))).cast("int")
    words = (F.col("safe_tokens") / F.lit(TOKENS_PER_WORD)).cast("int")
    return (
        models.withColumn("safe_tokens", safe)
        .withColumn("target", F.greatest(F.lit(LEAST_TARGET_WORDS), words))
        .withColumn("overlap", (F.col("target") * F.lit(OVERLAP_RATIO)).cast("int"))
    )


def chunk_words(
    sections: DataFrame,
    target: int | Column,
    overlap: int | Column,
    progress: DataFrame | None = None,
) -> DataFrame:
    """Overlapping word windows, one row each. Narrow: no shuffle without ``progress``.

    With ``progress``, windows up to a section's ``done`` are never turned into rows. The join is
    on one row per section, before the windows multiply, and the optimizer broadcasts the progress
    table only while it is small.
    """
    if progress is None:
        done = F.lit(0)
    else:
        sections = sections.join(progress.select("rel_path", "done"), "rel_path", "left")
        done = F.coalesce("done", F.lit(0))
    windows = word_windows(F.col("text"), target, overlap)
    numbered = bind(
        windows,
        lambda ws: F.transform(
            ws,
            lambda w, i: F.struct(
                (i + 1).cast("int").alias("chunk_index"),
                F.size(ws).alias("n_chunks"),
                w.alias("chunk"),
            ),
        ),
    )
    if progress is not None:
        numbered = F.filter(numbered, lambda c: c["chunk_index"] > done)
    return sections.select("rel_path", F.inline(numbered))


def chunk_fixed(
    sections: DataFrame, words: int = FIXED_WORDS, overlap: int = FIXED_OVERLAP
) -> DataFrame:
    return chunk_words(sections, words, overlap)


def chunk_dynamic(
    sections: DataFrame,
    max_context: int,
    ratio: float = SAFE_RATIO,
    progress: DataFrame | None = None,
) -> DataFrame:
    budget = token_budget(max_context, ratio)
    return chunk_words(sections, budget.target, budget.overlap, progress)


def is_small(chunk: Column, min_chars: int = MIN_CHUNK_CHARS) -> Column:
    return F.length(strip(chunk)) < min_chars


def small_chunks(chunks: DataFrame, min_chars: int = MIN_CHUNK_CHARS) -> DataFrame:
    """Chunks too small to ask about; they count as done."""
    return chunks.where(is_small(F.col("chunk"), min_chars))


def sendable_chunks(chunks: DataFrame, min_chars: int = MIN_CHUNK_CHARS) -> DataFrame:
    return chunks.where(~is_small(F.col("chunk"), min_chars))


def resume_filter(chunks: DataFrame, progress: DataFrame) -> DataFrame:
    """Chunks past the finished ones, for tables that already hold chunks (or replies)."""
    done = progress.select("rel_path", "done")
    return (
        chunks.join(done, "rel_path", "left")
        .where(F.col("chunk_index") > F.coalesce("done", F.lit(0)))
        .drop("done")
    )


def resume_failed(chunks: DataFrame, completed: DataFrame) -> DataFrame:
    """Chunks not among the completed (rel_path, chunk_index) pairs, so failed ones come back."""
    pairs = completed.select("rel_path", "chunk_index").distinct()
    return chunks.join(pairs, ["rel_path", "chunk_index"], "left_anti")


def chunk_label() -> Column:
    return F.format_string(
        "%s : chunk %d/%d", F.col("rel_path"), F.col("chunk_index"), F.col("n_chunks")
    )


def build_request(
    chunks: DataFrame,
    model: str,
    max_tokens: int,
    temperature: float = TEMPERATURE,
    prompt: str = PROMPT,
    json_object: bool = False,
    stream: bool | None = False,
) -> DataFrame:
    """Adds a ``request`` struct; ``to_json(request)`` is the body to send."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    fields = [
        F.lit(model).alias("model"),
        F.array(
            message("system", F.lit(prompt.strip())), message("user", strip(F.col("chunk")))
        ).alias("messages"),
        F.lit(float(temperature)).alias("temperature"),
        F.lit(int(max_tokens)).alias("max_tokens"),
    ]
    if stream is not None:
        fields.append(F.lit(stream).alias("stream"))
    if json_object:
        fields.append(F.struct(F.lit("json_object").alias("type")).alias("response_format"))
    return chunks.select("rel_path", "chunk_index", "n_chunks", F.struct(*fields).alias("request"))


def build_request_v0(
    chunks: DataFrame, model: str, prompt: str = EARLY_PROMPT, json_object: bool = True
) -> DataFrame:
    """The early form: a fixed token limit, no stream flag, optionally a JSON response format."""
    return build_request(
        chunks, model, EARLY_MAX_TOKENS, prompt=prompt, json_object=json_object, stream=None
    )
