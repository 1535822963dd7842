"""Fixed values.

Texts, label names and sentinels that results depend on. They are part of the data formats this library
reads and writes and must not be changed.
"""

# Multiple-choice prompt with options numbered from 0.
CHOICE_PROMPT_OPTIONS = "\nchoose only one of the following options: \n0. "
CHOICE_PROMPT_END = "\nRespond only with the number of the chosen option."

# Exam prompt with options numbered from 1.
EXAM_PROMPT_START = (
    "You are a medical student taking a multiple-choice exam. Four options are provided for each question. "
    "Only one of these options is the correct answer."
)
EXAM_PROMPT_END = "Solve this multiple-choice exam question and provide the correct answer."
ANSWER_PREFIX = "Answer: "

OPTION_COLUMNS = ["opa", "opb", "opc", "opd"]
MULTI_CHOICE = "multi"
INVALID_CHOICE = -1

# Entity tags in id order.
ENTITY_LABELS = ["O", "B-PER", "I-PER", "B-ORG", "I-ORG", "B-LOC", "I-LOC", "B-MISC", "I-MISC"]
MASKED_LABEL = -100

# Review categories and the class numbers they become.
CATEGORY_CLASSES = {-1: 0, 0: 1, 1: 2}

# Cells a CSV reader takes as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]
