"""Small fixed tables shipped as literals (broadcast-sized by construction).

FIXED VALUES. These must equal the public word lists and constants the
original scripts rely on, so they are written out plainly, in natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: English stop words (the common NLTK English list, 179 words) ---
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself it "
    "it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of "
    "at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don "
    "don't should should've now d ll m o re ve y ain aren aren't couldn couldn't "
    "didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't "
    "ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# --- FIXED VALUES: question words counted by the profile (no "when") ---
QUESTION_WORDS = ["how", "what", "why", "who", "where", "would", "whom", "which"]

# --- FIXED VALUES: strings pandas reads as missing by default ---
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- FIXED VALUES: English contractions and slang, lower-case key -> expansion ---
CONTRACTIONS = {
    "ain't": "are not", "aren't": "are not", "can't": "cannot",
    "can't've": "cannot have", "'cause": "because", "could've": "could have",
    "couldn't": "could not", "couldn't've": "could not have",
    "didn't": "did not", "doesn't": "does not", "don't": "do not",
    "hadn't": "had not", "hadn't've": "had not have", "hasn't": "has not",
    "haven't": "have not", "he'd": "he would", "he'd've": "he would have",
    "he'll": "he will", "he's": "he is", "how'd": "how did",
    "how'll": "how will", "how's": "how is", "i'd": "i would",
    "i'd've": "i would have", "i'll": "i will", "i'm": "i am",
    "i've": "i have", "isn't": "is not", "it'd": "it would",
    "it'll": "it will", "it's": "it is", "let's": "let us",
    "ma'am": "madam", "mayn't": "may not", "might've": "might have",
    "mightn't": "might not", "must've": "must have", "mustn't": "must not",
    "needn't": "need not", "o'clock": "of the clock", "oughtn't": "ought not",
    "shan't": "shall not", "she'd": "she would", "she'll": "she will",
    "she's": "she is", "should've": "should have", "shouldn't": "should not",
    "that'd": "that would", "that's": "that is", "there'd": "there would",
    "there's": "there is", "they'd": "they would", "they'll": "they will",
    "they're": "they are", "they've": "they have", "wasn't": "was not",
    "we'd": "we would", "we'll": "we will", "we're": "we are",
    "we've": "we have", "weren't": "were not", "what'll": "what will",
    "what're": "what are", "what's": "what is", "what've": "what have",
    "when's": "when is", "where'd": "where did", "where's": "where is",
    "where've": "where have", "who'd": "who would", "who'll": "who will",
    "who's": "who is", "who've": "who have", "why's": "why is",
    "won't": "will not", "would've": "would have", "wouldn't": "would not",
    "y'all": "you all", "you'd": "you would", "you'll": "you will",
    "you're": "you are", "you've": "you have",
    "gonna": "going to", "gotta": "got to", "wanna": "want to",
    "gimme": "give me", "lemme": "let me", "kinda": "kind of",
}

# --- FIXED VALUES: prompt pieces ---
T5_PREFIX = "ask question: "
EOS_TEXT = " </s>"
SEP_TOKEN = "<sep>"
SEP_PLACEHOLDER = "{sep_token}"

# --- FIXED VALUES: request form messages ---
MSG_EMPTY_CONTEXT = "Please make sure to enter your text in the box!"
MSG_EMPTY_N = "Please make sure to enter the number of questions!"
MSG_BAD_N = "The number of questions must be a whole number."
MSG_MODEL_FAILED = ("The text provided couldnt be handled by the model, please "
                    "rephrase your text or select another model!")

# --- FIXED VALUES: variant configuration (one row per model variant) ---
# name, prefix, uses keywords, joiner between context and keywords, priority
VARIANTS = [
    ("BART", "", False, " ", 0),
    ("T5", T5_PREFIX, False, SEP_TOKEN, 1),
    ("BART with keywords", "", True, " ", 2),
    ("T5 with keywords", T5_PREFIX, True, SEP_TOKEN, 3),
]
COMBINED = "combined"
MODEL_NAMES = [v[0] for v in VARIANTS]

# --- FIXED VALUES: feature lengths and generation limits ---
MAX_INPUT_LEN = 512
MAX_TARGET_LEN = 64
KEYWORD_RATIO = 0.2
TOP_K = 10
LABEL_IGNORE = -100

# --- FIXED VALUES: word-level vocabulary specials (pad, eos, unk) ---
PAD_TOKEN, EOS_TOKEN, UNK_TOKEN = "<pad>", "</s>", "<unk>"
SPECIAL_TOKENS = [PAD_TOKEN, EOS_TOKEN, UNK_TOKEN]
PAD_ID, EOS_ID, UNK_ID = 0, 1, 2

# --- FIXED VALUES: metric constants ---
METEOR_ALPHA, METEOR_BETA, METEOR_GAMMA = 0.9, 3.0, 0.5
BLEU_MAX_N = 4
BLEU_METHOD4_K = 5.0
BLEU_METHOD1_EPSILON = 0.1
TEXTRANK_DAMPING = 0.85
BOOTSTRAP_REPLICATES = 1000
BOOTSTRAP_PERCENTILES = (0.025, 0.5, 0.975)
