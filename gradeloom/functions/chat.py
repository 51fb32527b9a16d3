"""The canonical chat text and the character spans of it that carry loss."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The delimiters of the chat format.
START = "<|im_start|>"
END = "<|im_end|>"
CUE = START + "assistant\n"


def render_block(role: Column, content: Column) -> Column:
    """One message as chat text."""
    return F.concat(F.lit(START), role, F.lit("\n"), content, F.lit(END + "\n"))


def render_chat(messages: Column, add_generation_prompt: bool | Column = False) -> Column:
    """A conversation as chat text, optionally with the cue that asks for the next answer. The cue may
    hang on a condition, so that only the last part of a long conversation gets it."""
    text = F.array_join(F.transform(messages, lambda m: render_block(m["role"], m["content"])), "")
    if isinstance(add_generation_prompt, Column):
        return F.concat(text, F.when(add_generation_prompt, F.lit(CUE)).otherwise(F.lit("")))
    return F.concat(text, F.lit(CUE)) if add_generation_prompt else text


def render_user_prompt(text: Column) -> Column:
    """One user message, no system message, ready for generation."""
    return F.concat(render_block(F.lit("user"), text), F.lit(CUE))


def block_chars(role: Column, content: Column) -> Column:
    """Length of one message as chat text, without building it."""
    return F.length(role) + F.length(content) + F.lit(len(START) + len(END) + 2)


def _block_length(message: Column) -> Column:
    return block_chars(message["role"], message["content"])


def assistant_spans(messages: Column) -> Column:
    """Half-open `[start, end)` spans of the chat text that carry loss.

    A span covers an assistant message's content, the end mark and the newline after it, never
    the role header.
    """
    empty = F.struct(
        F.lit(0).alias("pos"),
        F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
    )

    def add(state: Column, message: Column) -> Column:
        after = state["pos"] + _block_length(message)
        start = state["pos"] + F.length(message["role"]) + F.lit(len(START) + 1)
        span = F.struct(start.alias("start"), after.alias("end"))
        spans = F.when(message["role"] == "assistant", F.array_append(state["spans"], span))
        return F.struct(after.alias("pos"), spans.otherwise(state["spans"]).alias("spans"))

    return F.aggregate(messages, empty, add, lambda state: state["spans"])


def trainable_chars(messages: Column) -> Column:
    """Number of characters that carry loss, without building the spans."""
    return F.aggregate(
        messages,
        F.lit(0),
        lambda n, m: n
        + F.when(m["role"] == "assistant", F.length(m["content"]) + F.lit(len(END) + 1)).otherwise(F.lit(0)),
    )


def chat_chars(messages: Column) -> Column:
    """Length of the chat text, without building it."""
    return F.aggregate(messages, F.lit(0), lambda n, m: n + _block_length(m))


def loss_coverage(messages: Column) -> Column:
    """Share of the chat text that carries loss; 0 flags a conversation nothing is learned from."""
    return F.try_divide(trainable_chars(messages), chat_chars(messages))


Template = Callable[..., Column]
_TEMPLATES: dict[str, Template] = {"reasoning_chatml": render_chat}


def register_template(name: str, render: Template) -> None:
    """Add a template: a function of (messages, add_generation_prompt) that returns chat text."""
    _TEMPLATES[name] = render


def resolve_chat_template(name: str | None) -> Template | None:
    """The template of that name; no name means the consumer keeps its own template."""
    if not name:
        return None
    if name not in _TEMPLATES:
        raise ValueError(f"no chat template is registered as {name!r}")
    return _TEMPLATES[name]
