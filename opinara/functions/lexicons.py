"""Fixed values of the text pipeline (word lists, patterns, formats).

Everything here is data, not logic: results depend on these exact values.
"""

from __future__ import annotations

# Stands in for a null or blank text, and for a text with no word left.
MISSING_TEXT = "desconocido"

# Canonical sentiment labels.
NEGATIVE, NEUTRAL, POSITIVE = "NEGATIVO", "NEUTRO", "POSITIVO"
SENTIMENTS = [NEGATIVE, NEUTRAL, POSITIVE]

# Star rating -> label.
RATING_LABELS = {1: NEGATIVE, 2: NEGATIVE, 3: NEUTRAL, 4: POSITIVE, 5: POSITIVE}

# Fixed values, in the order of their application.
CONTRACTIONS = {
    "isn't": "is not", "aren't": "are not", "wasn't": "was not", "weren't": "were not", "haven't": "have not",
    "hasn't": "has not", "hadn't": "had not", "wouldn't": "would not", "don't": "do not", "doesn't": "does not",
    "didn't": "did not", "couldn't": "could not", "shouldn't": "should not", "mightn't": "might not",
    "mustn't": "must not", "won't": "will not", "can't": "can not",
}

# English stop words (the public list of 179 words).
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Negations and intensifiers that carry sentiment; classifiers keep them.
SENTIMENT_STOPWORDS_KEPT = [
    "no", "not", "nor", "but", "against", "very", "isn't", "aren't", "wasn't", "doesn't",
]
CLASSIFIERS_KEEPING_SENTIMENT = ["KNN", "DecisionTree", "RandomForest", "NaiveBayes"]

# Whitespace as Python's str.split sees it; valid in Java and in RE2.
WHITESPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"

# Treebank-style splitting: (pattern, replacement with {n} for group n).
# No look-around and no back-reference, so any regex engine gives the same.
TOKEN_RULES = [
    (r'[;@#$%&?!"()\[\]{}<>*«»“”„‘’`]|\.\.+|--', " {0} "),
    (r"([:,])($|[^0-9])", " {1} {2}"),
    (r"([^.])\.( |$)", "{1} . {2}"),
    (r"([^' ])('ll|'re|'ve|n't|'s|'m|'d|')( |$)", "{1} {2}{3}"),
]
# Words the Treebank convention writes as two tokens.
TOKEN_PAIRS = {
    "cannot": "can not", "gimme": "gim me", "gonna": "gon na", "gotta": "got ta",
    "lemme": "lem me", "wanna": "wan na", "d'ye": "d 'ye", "more'n": "more 'n",
    "'tis": "'t is", "'twas": "'t was",
}
ALNUM_TOKEN = r"^[\p{L}\p{N}]+$"

# Noun endings: (ending, replacement).
NOUN_ENDINGS = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]

# Pictographs of one code point, as the inside of a character class.
EMOJI_CLASS = (r"\x{231A}\x{231B}\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{25FD}\x{25FE}\x{2600}-\x{27BF}\x{2B05}-\x{2B07}"
               r"\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}\x{1F004}\x{1F0CF}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F300}-\x{1FAFF}")
# A flag is two of these letters, a keycap a sign before U+20E3.
REGIONAL_LETTERS = "".join(chr(0x1F1E6 + i) for i in range(26))
KEYCAP = "⃣"
# What joins or styles emoji and has no name of its own.
EMOJI_JOINERS = "️‍"

# Emoji and their CLDR short names; a caller can pass a fuller table.
EMOJI_NAMES = {
    "😀": "grinning face", "😃": "grinning face with big eyes",
    "😄": "grinning face with smiling eyes", "😁": "beaming face with smiling eyes",
    "😆": "grinning squinting face", "😅": "grinning face with sweat",
    "🤣": "rolling on the floor laughing", "😂": "face with tears of joy",
    "🙂": "slightly smiling face", "🙃": "upside-down face", "😉": "winking face",
    "😊": "smiling face with smiling eyes", "😇": "smiling face with halo",
    "🥰": "smiling face with hearts", "😍": "smiling face with heart-eyes",
    "🤩": "star-struck", "😘": "face blowing a kiss", "😋": "face savoring food",
    "😜": "winking face with tongue", "🤗": "smiling face with open hands",
    "🤔": "thinking face", "😐": "neutral face", "😑": "expressionless face",
    "😏": "smirking face", "😒": "unamused face", "🙄": "face with rolling eyes",
    "😬": "grimacing face", "😌": "relieved face", "😔": "pensive face",
    "😴": "sleeping face", "😷": "face with medical mask", "🤮": "face vomiting",
    "😎": "smiling face with sunglasses", "😕": "confused face", "😟": "worried face",
    "🙁": "slightly frowning face", "😮": "face with open mouth",
    "😲": "astonished face", "😳": "flushed face", "🥺": "pleading face",
    "😢": "crying face", "😭": "loudly crying face", "😱": "face screaming in fear",
    "😞": "disappointed face", "😩": "weary face", "😫": "tired face",
    "😤": "face with steam from nose", "😡": "enraged face", "😠": "angry face",
    "🤬": "face with symbols on mouth", "💀": "skull", "💩": "pile of poo",
    "❤": "red heart", "💔": "broken heart", "💕": "two hearts", "💖": "sparkling heart",
    "💙": "blue heart", "💚": "green heart", "💛": "yellow heart", "💜": "purple heart",
    "💯": "hundred points", "💥": "collision", "👍": "thumbs up", "👎": "thumbs down",
    "👌": "OK hand", "👏": "clapping hands", "🙏": "folded hands", "💪": "flexed biceps",
    "🔥": "fire", "⭐": "star", "✨": "sparkles", "🎉": "party popper",
    "🏻": "light skin tone", "🏼": "medium-light skin tone", "🏽": "medium skin tone",
    "🏾": "medium-dark skin tone", "🏿": "dark skin tone",
    "✅": "check mark button", "❌": "cross mark", "🚀": "rocket", "😥": "sad but relieved face",
}

# Day-first date layouts tried in order.
DAY_FIRST_FORMATS = ["d/M/yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy-M-d", "d/M/yy", "d MMM yyyy"]
