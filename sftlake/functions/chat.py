"""Chat-template rendering as Column expressions (higher-order array functions, no UDF).

Messages are ``array<struct<role, content>>``. The tool form additionally reads
``tool_calls: array<struct<name, arguments>>`` on messages and a ``tools`` column of JSON
strings; ``arguments`` and tool definitions are taken as ready JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers and texts of the shipped chat template.
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
DEFAULT_SYSTEM = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
TOOLS_INTRO = (
    "\n\n# Tools\n\nYou may call one or more functions to assist with the user query.\n\n"
    "You are provided with function signatures within <tools></tools> XML tags:\n<tools>"
)
TOOLS_OUTRO = (
    "\n</tools>\n\nFor each function call, return a json object with function name and arguments "
    'within <tool_call></tool_call> XML tags:\n<tool_call>\n{"name": <function-name>, '
    '"arguments": <args-json-object>}\n</tool_call>' + IM_END + "\n"
)
GENERATION_PROMPT = IM_START + "assistant\n"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first_system(m: Column) -> Column:
    first = F.get(m, 0)  # null for an empty array (try_element_at trips codegen on built arrays)
    return F.coalesce(first["role"] == "system", F.lit(False)), first


def _block(role: Column, content: Column) -> Column:
    return F.concat(F.lit(IM_START), role, F.lit("\n"), F.coalesce(content, F.lit("")), F.lit(IM_END + "\n"))


def system_header(messages) -> Column:
    m = _col(messages)
    is_sys, first = _first_system(m)
    return F.concat(
        F.lit(IM_START + "system\n"),
        F.when(is_sys, F.coalesce(first["content"], F.lit(""))).otherwise(F.lit(DEFAULT_SYSTEM)),
        F.lit(IM_END + "\n"),
    )


def message_blocks(messages) -> Column:
    """array<string>: the rendered block of each message ('' for the leading system
    message, which lives in the header, and for roles the template does not print)."""
    m = _col(messages)

    def one(x, i):
        printed = (x["role"] == "user") | ((x["role"] == "system") & (i > 0)) | (x["role"] == "assistant")
        return F.when(printed, _block(x["role"], x["content"])).otherwise(F.lit(""))

    return F.transform(m, one)


def render_chat(messages, add_generation_prompt: bool = False) -> Column:
    """Render role/content messages with the default template (no tools)."""
    m = _col(messages)
    text = F.concat(system_header(m), F.array_join(message_blocks(m), ""))
    return F.concat(text, F.lit(GENERATION_PROMPT)) if add_generation_prompt else text


def render_chat_tools(messages, tools, add_generation_prompt: bool = False) -> Column:
    """Full template: tools preamble, assistant tool calls, grouped tool responses."""
    m = _col(messages)
    t = _col(tools)
    is_sys, first = _first_system(m)
    sys_text = F.when(is_sys, F.coalesce(first["content"], F.lit(""))).otherwise(F.lit(DEFAULT_SYSTEM))
    has_tools = F.coalesce(F.size(t) > 0, F.lit(False))
    tools_header = F.concat(
        F.lit(IM_START + "system\n"),
        sys_text,
        F.lit(TOOLS_INTRO),
        F.array_join(F.transform(t, lambda j: F.concat(F.lit("\n"), j)), ""),
        F.lit(TOOLS_OUTRO),
    )
    header = F.when(has_tools, tools_header).otherwise(system_header(m))
    n = F.size(m)

    def one(x, i):
        role = x["role"]
        calls = x["tool_calls"]
        no_calls = F.coalesce(F.size(calls) == 0, F.lit(True))
        plain = (role == "user") | ((role == "system") & (i > 0)) | ((role == "assistant") & no_calls)
        content = F.coalesce(x["content"], F.lit(""))
        call_text = F.array_join(
            F.transform(
                calls,
                lambda c: F.concat(
                    F.lit('\n<tool_call>\n{"name": "'), c["name"], F.lit('", "arguments": '), c["arguments"],
                    F.lit("}\n</tool_call>"),
                ),
            ),
            "",
        )
        assistant_calls = F.concat(
            F.lit(IM_START + "assistant"),
            F.when(content != "", F.concat(F.lit("\n"), content)).otherwise(F.lit("")),
            call_text,
            F.lit(IM_END + "\n"),
        )
        prev_role = F.get(m, i - 1)["role"]  # null outside the array
        next_role = F.get(m, i + 1)["role"]
        opens = (i == 0) | F.coalesce(prev_role != "tool", F.lit(True))
        closes = (i == n - 1) | F.coalesce(next_role != "tool", F.lit(True))
        tool_text = F.concat(
            F.when(opens, F.lit(IM_START + "user")).otherwise(F.lit("")),
            F.lit("\n<tool_response>\n"),
            content,
            F.lit("\n</tool_response>"),
            F.when(closes, F.lit(IM_END + "\n")).otherwise(F.lit("")),
        )
        return (
            F.when(plain, _block(role, x["content"]))
            .when(role == "assistant", assistant_calls)
            .when(role == "tool", tool_text)
            .otherwise(F.lit(""))
        )

    text = F.concat(header, F.array_join(F.transform(m, one), ""))
    return F.concat(text, F.lit(GENERATION_PROMPT)) if add_generation_prompt else text
