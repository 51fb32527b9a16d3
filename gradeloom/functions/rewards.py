"""Rule-based grading of math completions as Column expressions.

Answers are compared as normalised text, never as numbers: `5.00` and `5` differ.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeloom.functions.text import SPACE, last_line, strip

# Fixed values. The two accepted answer forms, the shape of a number, and the reward amounts.
# A hashed answer is the rest of its line, and blanks before it may run over line ends; only \n ends
# a line. Nd are the digits of all scripts. No pattern needs more than one pass over a line.
BOXED = r"\\boxed\{[^}]*\}"
HASHED = rf"####{SPACE}*[^\n]+"
NUMBER = r"-?\p{Nd}[\p{Nd},]*(?:\.(?!0(?!\p{Nd}))\p{Nd}+)?"
DIGIT = r"\p{Nd}"
CORRECT = 1.0
WELL_FORMED = 0.1


def _first_number(text: Column) -> Column:
    """The first number without commas, or an empty string.

    The pattern leaves out a fraction that is empty or exactly `0`, so one search does all of the
    normalising: `12.` and `12.0` read as `12`, while `5.00` stays as it is.
    """
    return F.replace(F.regexp_extract(text, NUMBER, 0), F.lit(","), F.lit(""))


def normalize_number(text: Column) -> Column:
    """The first number of a text in normal form; null if there is none."""
    return F.when(text.rlike(DIGIT), _first_number(text))


def boxed_mark(text: Column) -> Column:
    """The first boxed answer with its wrapper, or an empty string.

    The wrapper holds no digit, so the number in the mark is the number in the box, and a
    non-empty mark also tells that the form is present (an empty box counts).
    """
    return F.regexp_extract(text, BOXED, 0)


def hashed_mark(text: Column) -> Column:
    """The first `#### answer` with its marker, or an empty string."""
    return F.regexp_extract(text, HASHED, 0)


def _candidates(text: Column) -> Column:
    """Where an answer may stand, in order of preference, on lines of their own.

    The first number of this text is the predicted answer. There is no branch in it, so the marks
    that grading needs several times are found once per row.
    """
    return F.concat_ws("\n", boxed_mark(text), hashed_mark(text), last_line(text), text)


def predicted_answer(text: Column) -> Column:
    """Boxed number, else hashed number, else first number of the last line, else of the text."""
    return F.when(text.rlike(DIGIT), _first_number(_candidates(text)))


def extract_gold(answer: Column) -> Column:
    """Text after the last `####`, stripped, without commas; the whole text when unmarked."""
    tail = F.element_at(F.split(answer, "####", -1), -1)
    return F.replace(strip(tail), F.lit(","), F.lit(""))


def correctness_reward(text: Column, gold: Column) -> Column:
    predicted = _first_number(_candidates(text))
    return F.when((predicted != "") & (predicted == _first_number(gold)), F.lit(CORRECT)).otherwise(F.lit(0.0))


def format_reward(text: Column, gold: Column | None = None) -> Column:
    formed = (boxed_mark(text) != "") | (hashed_mark(text) != "")
    return F.when(formed, F.lit(WELL_FORMED)).otherwise(F.lit(0.0))


Scorer = Callable[[Column, Column], Column]

# One entry per task; the component columns and the scalar score both come from it.
_SCORERS: dict[str, dict[str, Scorer]] = {
    "gsm8k": {"correctness": correctness_reward, "format": format_reward},
}


def register_scorer(task: str, components: dict[str, Scorer]) -> None:
    """Add a task. A component maps (text, gold) columns to a double column; a pandas UDF will do."""
    if not components:
        raise ValueError(f"no reward components given for {task!r}")
    _SCORERS[task] = dict(components)


def reward_components(task: str) -> dict[str, Scorer]:
    if task not in _SCORERS:
        raise ValueError(f"no rewards registered for task {task!r}")
    return _SCORERS[task]


def scorer_names() -> list[str]:
    return list(_SCORERS)


def score(task: str, text: Column, gold: Column) -> Column:
    """All components of a task summed into one double."""
    parts = [component(text, gold) for component in reward_components(task).values()]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def gsm8k_score(text: Column, gold: Column) -> Column:
    return score("gsm8k", text, gold)


def score_by_source(data_source: Column, text: Column, gold: Column, fail: bool = True) -> Column:
    """Route each row to the scorer its `data_source` names.

    An unknown or missing source raises inside the returned column, so the check cannot be pruned
    while the score is used; with `fail=False` such rows score null and can be set aside.
    """
    names = scorer_names()
    routed = F.when(data_source == names[0], score(names[0], text, gold))
    for name in names[1:]:
        routed = routed.when(data_source == name, score(name, text, gold))
    if not fail:
        return routed
    message = F.concat(F.lit("no reward scorer for data_source: "), F.coalesce(data_source, F.lit("null")))
    return routed.otherwise(F.raise_error(message).cast("double"))


def completion_text(df: DataFrame, name: str, fail: bool = True) -> Column:
    """The text to grade: the last message's content, or the column as a string.

    A completion without messages fails the job, or with `fail=False` has a null text.
    """
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.ArrayType):
        last = F.element_at(column, -1) if fail else F.try_element_at(column, F.lit(-1))
        return last["content"]
    return F.coalesce(column.cast("string"), F.lit("None"))


def rollout_text(turns: Column) -> Column:
    """Content of the last turn of a rollout; empty when there is no turn or no content."""
    return F.coalesce(F.try_element_at(turns, F.lit(-1))["content"], F.lit(""))


def weighted_rubric(rewards: list[tuple[float, Column]]) -> Column:
    """Weighted sum of reward columns."""
    if not rewards:
        raise ValueError("a rubric needs at least one reward")
    total = F.lit(0.0)
    for weight, reward in rewards:
        total = total + F.lit(float(weight)) * reward
    return total


def missing_eos_penalty(reward: Column, has_eos: Column, penalty: float = 1.0) -> Column:
    """Take `penalty` off rewards whose generation never ended."""
    return reward - F.when(has_eos, F.lit(0.0)).otherwise(F.lit(float(penalty)))


def kl_shaped_reward(reward: Column, kl: Column, beta: float = 0.04) -> Column:
    """Reward with the KL penalty inside, as PPO wants it (GRPO keeps KL in the loss)."""
    return reward - F.lit(float(beta)) * kl
