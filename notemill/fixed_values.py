"""Formats and patterns that have to be exactly these for results to be right.

Patterns are written in Python ``re`` notation, where ``\\s``, ``\\d``, ``\\W`` and ``\\b`` mean the
Unicode classes. ``notemill.functions.regex`` gives the same pattern in another engine's notation.
"""

# --- fixed values: links in parentheses -------------------------------------------------------
LINK_PARENTHESIS = r'\((?=[^)]*(https?://|doi\.org|reactome|10\.\d{4,9}))[^)]*\)'
EMPTY_PARENTHESES = r'\(\s*\)'
SPACE_BEFORE_PUNCTUATION = r'\s+([.,;:!?])'
BLANK_RUN = r'\s{2,}'

# --- fixed values: citation cleaning, applied in this order -----------------------------------
# (what, pattern, argument): "take" moves every match (group number = argument) to the reference
# list and deletes it; "put" replaces it by the argument; "squeeze" makes whitespace runs one blank
# and strips.
CITATION_STEPS = (
    ("take", r'\(\s*(?:e\.g\.\s*)?[A-Z][^()]*?\d{4}[a-z]?\s*\)', 0),
    ("take", r'\b[A-Z][a-z]+(?:\s(?:et al\.?|and\s[A-Z][a-z]+)?)?(?:,)?\s+et al\.?(?:,)?\s*\d{4}[a-z]?\b', 0),
    ("put", r'(No|Yes)(No|Yes)', r'\1 \2 '),
    ("put", r'(\d{4}[a-z]?)([A-Z][A-Z0-9]+\s*\()', r'\1 \2'),
    ("put", r'(RNA|Protein|NoYes|NoNo|YesNo|YesYes)([A-Z][A-Z0-9]+)', r'\1 \2'),
    ("put", r'([a-z])([A-Z][a-z]+\s+et\s+al)', r'\1 \2'),
    ("put", r'(\d{4}[a-z]?)([A-Z][a-z]+\s+et\s+al)', r'\1 \2'),
    ("take", r'\([^()]*?\d{4}[a-z]?[^()]*?\)', 0),
    ("take", r'\breviewed\s+(in|by)(?:\s+[A-Z][A-Za-z]*(?:\s+(?:[A-Z][A-Za-z]*|et\s+al\.?|and\s+[A-Z][A-Za-z]*))*)?\s*\d{4}[a-z]?', 1),
    ("take", r'\b[A-Z][A-Za-z]*(?:\s+[A-Z][A-Za-z]*)*\s+et\s+al\.?\s+\d{4}[a-z]?', 0),
    ("take", r'\b[A-Z][A-Za-z]+\s+\d{4}[a-z]?\b', 0),
    ("take", r'\b[A-Z][A-Za-z]+\s+and\s+[A-Z][A-Za-z]+\s+\d{4}[a-z]?\b', 0),
    ("put", r'\s*:\s*', ': '),
    ("put", r'\s+([.,;:!?])', r'\1'),
    ("put", r'([.,;:!?])\s*([.,;:!?])', r'\1\2'),
    ("put", r'^\W+$', ''),
    ("squeeze", None, None),
    ("put", r'\(\s*\)', ''),
    ("put", r'\.\.+', '.'),
    ("put", r'\.\s*\.', '.'),
    ("put", r'\s+([.!?])$', r'\1'),
)
REFERENCE_SEPARATOR = "; "

# --- fixed values: markup ---------------------------------------------------------------------
DROPPED_ELEMENTS = ("notes", "annotation")
DROPPED_ATTRIBUTE = "metaid"
PARAGRAPH_ADDRESS = "http://www.w3.org/1999/xhtml"

# --- fixed values: sentence filter ------------------------------------------------------------
ONLY_PUNCTUATION = r'^\W+$'          # whitespace is a non-word character too
ASCII_LETTER = r'[a-zA-Z]'

# --- fixed values: entity names ---------------------------------------------------------------
ENTITY_CLASS = "EntityWithAccessionedSequence"
ENTITY_QUALIFIER = " ["
ENTITY_STOP_ENDINGS = (" gene", " activated")

# --- fixed values: length categories and split ------------------------------------------------
LENGTH_CATEGORIES = ("short", "medium", "long", "very_long")
SPLIT_SHARES = {"train": 0.8, "val": 0.15, "test": 0.05}
SPLIT_SEED = 42

# --- fixed values: prompts, chat and special tokens -------------------------------------------
INSTRUCTION_TEMPLATE = "Translate the following SBML code to English:\n\n{snippet}"
PROMPT_HEAD = "### Instruction:\n"
PROMPT_TAIL = "\n### Response:\n"
RESPONSE_MARKER = "### Response:"
INSTRUCTION_MARKER = "### Instruction:"
END_OF_TURN = "<|EOT|>"
STOP_TOKENS = ("<|EOT|>", "<|end|>", "<|endoftext|>")
BOS_TOKEN = "<｜begin▁of▁sentence｜>"
EOS_TOKEN = "<｜end▁of▁sentence｜>"
PAD_TOKEN = "[PAD]"
IGNORE_INDEX = -100
MODEL_MAX_LENGTH = 1024
ENCODE_BATCH_ROWS = 1000

# --- fixed values: characters that XML names, and the parts of a reaction that may hold notes of their own ----
NAMED_CHARACTERS = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}
INNER_ELEMENTS = ("listOf\\w+", "kineticLaw", "annotation")
