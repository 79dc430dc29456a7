"""Texts, formats and numbers that results depend on and that must not change."""

from __future__ import annotations

# Generation settings stamped on every row.
TEMPERATURE = 0.2
MAX_TOKENS = 400

# Sizes.
BATCH_SIZE = 10
MAX_SEQ_LENGTH = 256
TEST_SIZE = 0.2
SPLIT_SEED = 42
KEEP_VERSIONS = 3

# Shard names.
SHARD_PREFIX = "batch-"
SHARD_FORMAT = "batch-%07d-%07d"

# Judge scores.
JUDGE_METRICS = ("answer_correctness", "answer_relevance", "faithfulness")
SCORE_PATTERN = "[1-5]"
DEFAULT_SCORE = 3.0

# Lowest value with which a metric passes.
THRESHOLDS = {
    "rougeL/v1/f1_score": 0.35,
    "bleu_score/v1/scores": 15.0,
    "answer_correctness/v1/mean": 3.5,
    "answer_relevance/v1/mean": 3.5,
    "faithfulness/v1/mean": 4.0,
}

# Threshold names whose metric carries another name in the metric table.
METRIC_OF_THRESHOLD = {
    "rougeL/v1/f1_score": "rougeL",
    "bleu_score/v1/scores": "bleu",
}

# Characters that count as white space when text is stripped or tested for being blank.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A word token, after lower-casing, and what lies between two tokens.
TOKEN_PATTERN = "[a-z0-9]+"
TOKEN_GAP = "[^a-z0-9]+"

# Request texts. Names in braces are columns.
PROMPTS = {
    "instructions": (
        "batch_size:{batch_size} , topic:{topic}, model:{model}, "
        "max_tokens:{max_tokens}, temperature:{temperature}"
    ),
    "gpt_output": "instruction:{instruction}",
    "gemini_output": "instruction: {instruction}",
    "answer_correctness": (
        "You are an expert evaluator. Score how factually correct the answer is compared to the reference.\n"
        "Score from 1 (completely wrong) to 5 (perfectly correct).\n"
        "Respond with only a single integer between 1 and 5.\n"
        "\n"
        "Question: {inputs}\n"
        "Reference answer: {targets}\n"
        "Model answer: {outputs}\n"
        "\n"
        "Score:"
    ),
    "answer_relevance": (
        "You are an expert evaluator. Score how relevant and on-topic the answer is to the question.\n"
        "Score from 1 (completely irrelevant) to 5 (perfectly relevant).\n"
        "Respond with only a single integer between 1 and 5.\n"
        "\n"
        "Question: {inputs}\n"
        "Model answer: {outputs}\n"
        "\n"
        "Score:"
    ),
    "faithfulness": (
        "You are an expert evaluator. Score how faithful the answer is to the reference — does it avoid "
        "hallucination or unsupported claims?\n"
        "Score from 1 (many hallucinations) to 5 (fully faithful).\n"
        "Respond with only a single integer between 1 and 5.\n"
        "\n"
        "Reference: {targets}\n"
        "Model answer: {outputs}\n"
        "\n"
        "Score:"
    ),
}
