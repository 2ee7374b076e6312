"""Final conversations from logged events, and their training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybrook.llm.common import table

#: Strings that chat templates give a meaning.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
OPEN, CLOSE = "<s>", "\n</s>\n"
_ANY = "|".join(
    "".join("\\" + c if c in "[]|<>/" else c for c in control) for control in CONTROLS
)
_EVENTS = ("message", "delta", "edit", "regenerate")


def escaped(text: Column) -> Column:
    """Put a backslash before each control string, after those that stand there."""
    return F.regexp_replace(text, rf"(\\*)({_ANY})", r"\\$1$2")


def unescaped(text: Column) -> Column:
    """Take back one backslash before each control string."""
    return F.regexp_replace(text, rf"\\(\\*)({_ANY})", "$1$2")


def _escaped_role(role: Column) -> Column:
    # A role stands on a line of its own.
    marked = F.replace(role, F.lit("%"), F.lit("%25"))
    return escaped(F.replace(marked, F.lit("\n"), F.lit("%0A")))


def _unescaped_role(role: Column) -> Column:
    lines = F.replace(unescaped(role), F.lit("%0A"), F.lit("\n"))
    return F.replace(lines, F.lit("%25"), F.lit("%"))


def final_messages(events: DataFrame) -> DataFrame:
    """Fold logged events into messages: ``conv_id, place, role, text``.

    Events are ``conv_id, seq, msg_id, kind, role, text``. In the order of ``seq``
    a ``message`` or ``edit`` sets the text of its message, a ``delta`` is put at
    its end, and a ``regenerate`` sets it anew and takes back every message that
    began after it. Other kinds are ignored. Equal ``seq`` go by kind, role and text. NULL texts
    and roles are empty; a message has its first event's role. Messages come in
    the order of their first event. NULL ids are ids of their own.
    """
    clean = events.filter(F.col("kind").isin(*_EVENTS)).select(
        "conv_id",
        "seq",
        "msg_id",
        "kind",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # One exchange by conversation serves this window, the fold and all that follows.
    conversation = Window.partitionBy("conv_id")
    order = ["seq", "kind", "role", "text"]
    of_message = Window.partitionBy("conv_id", "msg_id")
    later = conversation.orderBy("place_of_event").rowsBetween(1, Window.unboundedFollowing)
    numbered = clean.withColumn("place_of_event", F.row_number().over(conversation.orderBy(*order)))
    numbered = numbered.withColumn("place", F.min("place_of_event").over(of_message))
    # A message goes if a later regeneration names one that began before it.
    taken_back = F.min(F.when(F.col("kind") == "regenerate", F.col("place"))).over(later)
    numbered = numbered.withColumn("gone", F.coalesce(taken_back < F.col("place"), F.lit(False)))
    # Texts count from the last event that sets them.
    sets = F.max(F.when(F.col("kind") != "delta", F.col("place_of_event"))).over(of_message)
    live = numbered.withColumn("since", F.coalesce(sets, F.lit(0))).withColumn(
        "dropped", F.max(F.col("gone") & (F.col("place_of_event") == F.col("place"))).over(of_message)
    )
    live = live.withColumn("role", F.first("role").over(of_message.orderBy("place_of_event")))
    live = live.filter(~F.col("dropped") & (F.col("place_of_event") >= F.col("since")))
    parts = F.array_sort(F.collect_list(F.struct("place_of_event", "text")))
    folded = live.groupBy("conv_id", "msg_id", "place", "role").agg(parts.alias("parts"))
    whole = F.array_join(F.transform("parts", lambda part: part["text"]), "")
    return folded.select("conv_id", "place", "role", whole.alias("text"))


def rendered(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss``.

    A turn is ``<s>role``, a line break, the escaped text, and ``</s>`` on a line of
    its own. ``loss`` lists the texts of the role ``trained``: ``turn``, ``start`` from
    the beginning of the text, ``offset`` from that of the turn, ``length``, in code
    points. Rows are escaped before they meet; the row of a conversation is as long as
    the conversation.
    """
    head = F.concat(F.lit(OPEN), _escaped_role(F.col("role")), F.lit("\n"))
    turns = messages.select(
        "conv_id", "place", "role", head.alias("head"), escaped(F.col("text")).alias("body")
    )
    length = F.length("head") + F.length("body") + len(CLOSE)
    before = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumns(
        {
            "turn": F.row_number().over(Window.partitionBy("conv_id").orderBy("place")) - 1,
            "start": F.coalesce(F.sum(length).over(before), F.lit(0)) + F.length("head"),
        }
    )
    span = F.struct("turn", "start", F.length("head").alias("offset"), F.length("body").alias("length"))
    text = F.concat("head", "body", F.lit(CLOSE))
    rows = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", text.alias("text")))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("role") == trained, span))).alias("loss"),
    )
    joined = F.array_join(F.transform("turns", lambda turn: turn["text"]), "")
    return rows.select("conv_id", joined.alias("formatted"), "loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role and text) and ``loss_text``, read from the formatted text."""
    # What follows the first mark; nothing but a mark stands before it.
    pieces = F.slice(F.split("formatted", r"(?<!\\)<s>"), 2, F.size(F.split("formatted", r"(?<!\\)<s>")))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        size = F.length(piece) - F.length(role) - 1 - len(CLOSE)
        text = piece.substr(F.length(role) + 2, size)
        return F.struct(_unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    def masked(span: Column) -> Column:
        # The mark itself is cut off by the split.
        piece = F.get(F.col("pieces"), span["turn"])
        return unescaped(piece.substr(span["offset"] - len(OPEN) + 1, span["length"]))

    return (
        formatted.withColumn("pieces", pieces)
        .withColumn("turns", F.transform("pieces", turn))
        .withColumn("loss_text", F.array_join(F.transform("loss", masked), ""))
        .drop("pieces")
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """Each row of a table of turns as one ``message`` event with an id of its own."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        "conv_id",
        F.row_number().over(order).alias("seq"),
        F.row_number().over(order).alias("msg_id"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )


_PROBE = "</s>[INST] ok [/INST]"


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(_PROBE).alias("text"),
    )
    output = rendered(final_messages(conversation_events(rows.unionByName(probe))))
    back = read_back(output)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


_ANY_SQL = _ANY.replace(r"\<", "<").replace(r"\>", ">").replace(r"\/", "/")
ORACLES = {
    "op8_chat": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{_PROBE}'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({len(OPEN) + 1 + len(CLOSE)} + length(role) + length(regexp_replace(text, '(\\\\*)({_ANY_SQL})', '\\\\\\1\\2', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
""",
}
