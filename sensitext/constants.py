"""Values that results depend on."""

# Special token ids, vocabulary size and sequence lengths.
PAD_ID = 0
UNK_ID = 100
CLS_ID = 101
SEP_ID = 102
MASK_ID = 103
SPECIAL_TOKENS = {
    "[PAD]": PAD_ID,
    "[UNK]": UNK_ID,
    "[CLS]": CLS_ID,
    "[SEP]": SEP_ID,
    "[MASK]": MASK_ID,
}
FIRST_FREE_ID = 104
VOCAB_SIZE = 21128
MODEL_MAX_LENGTH = 512
MAX_LENGTH = 128
MAX_WORD_CHARS = 100

# Class names.
ID2LABEL = {0: "非敏感", 1: "敏感"}

# What a CSV cell may hold to count as missing.
PANDAS_NA = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Defaults of scoring, training, distillation and parity.
SEED = 42
THRESHOLD = 0.5
TEMPERATURE = 4.0
KD_WEIGHT = 1.0
HIDDEN_WEIGHT = 0.5
TRAIN_BATCH = 16
DISTILL_BATCH = 32
ENCODE_BATCH = 1000
TEACHER_WEIGHT_DECAY = 0.01
STUDENT_EPOCHS = 6
STUDENT_LR = 3e-5
LOG_EVERY = 50
CHECKPOINT_LIMIT = 2
PARITY_TOLERANCE = 1e-4
