"""C4 as a stream: numbered turns of many conversations.

Inputs ``(conv_id, input_seq, user_input, ai_reply)`` arrive in files, in any
order and possibly twice. ``input_seq`` counts a conversation's inputs from 1, as
its client numbered them. Keyed state per conversation holds the next number, the
last turn and the inputs that wait for an earlier one; an input is appended as a
user and an assistant turn as soon as all earlier ones have been. So turns are
gapless and unique and never change, whatever the order of files and restarts,
and equal what ``conversation.append_turns`` gives for all inputs at once. An
input whose number was appended before is a repeat and is dropped; of several
waiting inputs of one number the first that arrived counts. An input after a gap
waits for as long as the gap stays. Inputs without a number are dropped.

The file sink's own log and the checkpoint make a restarted stream continue where
it stopped without losing or repeating turns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import constants as K
from ..operators.conversation import display_names

INPUT_SCHEMA = "conv_id long, input_seq long, user_input string, ai_reply string"
MESSAGE_SCHEMA = "conv_id long, turn long, role string, content string, display_role string"
# next number, last turn, JSON object of waiting inputs: number -> [user input, reply]
STATE_SCHEMA = "next long, turn long, waiting string"


def _number(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    upto, turn, waiting = state.get if state.exists else (1, None, "{}")
    held = {int(k): v for k, v in json.loads(waiting).items()}
    names = ("", "")
    for pdf in batches:
        for seq, user, reply, last, who, ai in zip(pdf["input_seq"], pdf["user_input"], pdf["ai_reply"], pdf["last_turn"], pdf["user_name"], pdf["ai_name"]):
            names = (who, ai)
            turn = int(last) if turn is None else turn
            if seq >= upto:
                held.setdefault(int(seq), [user, reply])
    rows = []
    while upto in held:
        user, reply = held.pop(upto)
        rows += [(turn + 1, "user", user, names[0]), (turn + 2, "assistant", reply, names[1])]
        upto, turn = upto + 1, turn + 2
    state.update((upto, turn, json.dumps(held)))
    if rows:
        out = pd.DataFrame(rows, columns=["turn", "role", "content", "display_role"])
        out.insert(0, "conv_id", key[0])
        yield out


def numbered_turns(inputs: DataFrame, heads: DataFrame, setups: DataFrame) -> DataFrame:
    """Messages to append for a stream of inputs. ``heads(conv_id, last_turn)``: the
    conversations' last turns before the stream began (none: -1), read when a
    conversation's first input arrives."""
    named = inputs.filter(F.col("conv_id").isNotNull() & F.col("input_seq").isNotNull()).join(heads, "conv_id", "left").join(display_names(setups), "conv_id", "left")
    rows = named.select("conv_id", "input_seq", "user_input", "ai_reply", F.coalesce("last_turn", F.lit(-1)).cast("long").alias("last_turn"),
                        F.coalesce("user_name", F.lit(K.DEFAULT_USER_ROLE)).alias("user_name"), F.coalesce("ai_name", F.lit(K.DEFAULT_AI_ROLE)).alias("ai_name"))
    return rows.groupBy("conv_id").applyInPandasWithState(_number, MESSAGE_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


def start_turns(inputs: DataFrame, heads: DataFrame, setups: DataFrame, out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append the turns of an input stream to the Parquet table at ``out_path``."""
    w = numbered_turns(inputs, heads, setups).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start(out_path)


def read_turns(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(out_path)
