"""They decide results, so they are stated here as plain text."""

# Rate every waveform is brought to, in samples per second.
TARGET_RATE = 16_000

# Rows per Parquet row group in the written corpus.
ROWS_PER_GROUP = 100
BATCH_ROWS = 100

# Splits of a corpus.
SPLITS = ("train", "validation", "test")

# Language code and state used when a transcript corpus names none.
TRANSCRIPT_LANGUAGE = "gom_Deva"
TRANSCRIPT_STATE = "Goa"

# PCM16 scales: writing multiplies by 32767, reading divides by 32768.
PCM16_WRITE_SCALE = 32767
PCM16_READ_SCALE = 32768

# Punctuation removed for every language.
ASCII_PUNCTUATION = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""

# Punctuation removed in addition, by base language.
CJK_PUNCTUATION = {
    "zh": "。，、；：？！…—·ˉ¨々～‖∶＂＇｀｜〃〔〕〈〉《》「」『』．〖〗【】（）［］｛｝",
    "ja": "。、・；：？！…ー～〜「」『』（）｛｝［］【】《》〈〉〔〕",
    "ko": "。、；：？！…—～·ㆍ「」『』（）｛｝［］【】《》〈〉〔〕",
}

# Kinds of brackets whose content counts as annotation, in the order of their removal.
BRACKETS = ("[]", "<>", "{}", "()")

# What is deleted from a transcript, in order: {translations}, <tags>, runs of dashes.
TRANSCRIPT_NOISE = (r"\{[^}]*\}", r"<[^>]*>", r"--+")

# Marks deleted from a transcript when its punctuation is unwanted.
TRANSCRIPT_PUNCTUATION = "।॥?!,;:.'\""

# Language assumed for a table without a language column.
DEFAULT_LANGUAGE = "en"

# Unicode white space, for Java regular expressions.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Characters that count as digits beside the decimal digits \p{Nd}: superscripts,
# subscripts, circled and other numbered forms, as Java ranges.
OTHER_DIGITS = (
    r"\x{b2}-\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}"
    r"\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)

# Decimal digits of scripts that Java 17 does not know yet (Tangsa, Kawi, Nag Mundari).
NEWER_DECIMAL_DIGITS = r"\x{16ac0}-\x{16ac9}\x{11f50}-\x{11f59}\x{1e4f0}-\x{1e4f9}"
