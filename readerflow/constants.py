"""Fixed values and limits.

Everything under "Fixed values" must equal what the reading-practice app this
engine reproduces uses, or results differ: prompt texts, the book catalogue,
voice table, heading and marker patterns, defaults and limits. They are stated
plainly here, in their natural order, and nowhere else.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Fixed values (must match the reproduced application exactly)
# --------------------------------------------------------------------------

# Book catalogue: title (author in parentheses) -> book id.
CATALOG = [
    ("Pride and Prejudice (Jane Austen)", 1342),
    ("Alice's Adventures in Wonderland (Lewis Carroll)", 11),
    ("The Adventures of Tom Sawyer (Mark Twain)", 74),
    ("Great Expectations (Charles Dickens)", 1400),
    ("The Picture of Dorian Gray (Oscar Wilde)", 174),
    ("Emma (Jane Austen)", 158),
    ("Sense and Sensibility (Jane Austen)", 161),
    ("The Scarlet Letter (Nathaniel Hawthorne)", 25344),
    ("Frankenstein (Mary Shelley)", 84),
    ("Dracula (Bram Stoker)", 345),
]

# Download locations, in the order they are tried (priority 1, 2, 3).
BOOK_LOCATIONS = [
    "https://www.gutenberg.org/files/{book_id}/{book_id}-0.txt",
    "https://www.gutenberg.org/files/{book_id}/{book_id}.txt",
    "https://www.gutenberg.org/cache/epub/{book_id}/pg{book_id}.txt",
]

# Header and footer markers, and the chapter heading (matched case-insensitively).
START_MARKER = r"\*\*\* START OF (THIS|THE) PROJECT GUTENBERG"
END_MARKER = r"\*\*\* END OF (THIS|THE) PROJECT GUTENBERG"
HEADING = r"(CHAPTER\s+[IVXLC\d]+[^\n]*)"
FULL_TEXT_TITLE = "Full Text"

# Limits and defaults.
MAX_BOOK_CHARS = 30000
MAX_CHAPTER_CHARS = 3000
CHAPTER_JOINER = "\n\n"
MAX_PROMPT_CHARS = 4000
DEFAULT_CHAPTERS = 2
MAX_ROLEPLAY_LINES = 8
ROLEPLAY_DEFAULT_LINES = 5
ROLEPLAY_MIN_LINES = 3
ROLEPLAY_MAX_LINES = 10
MIN_MESSAGES_FOR_ANALYSIS = 2
PREVIEW_LINE_CHARS = 30

# Difficulty levels; missing difficulty counts as Intermediate.
DIFFICULTIES = ["Beginner", "Intermediate", "Advanced"]
DEFAULT_DIFFICULTY = "Intermediate"
# Difficulty -> badge style class; unknown -> badge-intermediate.
DIFFICULTY_BADGES = [
    ("Beginner", "badge-beginner"),
    ("Intermediate", "badge-intermediate"),
    ("Advanced", "badge-advanced"),
]
DEFAULT_BADGE = "badge-intermediate"

# Speaker filter sentinel meaning "all speakers".
ALL_SPEAKERS = "전체"
UNKNOWN_SPEAKER = "Unknown"

# Score bands: >= 80 green, >= 60 yellow, else red.
SCORE_BANDS = [(80, "#00b894"), (60, "#fdcb6e")]
SCORE_BAND_LOW = "#e17055"

# Role-play defaults.
DEFAULT_OPENING_LINE = "Let's begin our scene!"
DEFAULT_AI_ROLE = "AI"
DEFAULT_USER_ROLE = "You"

# Text-to-speech voices: key -> (voice name, gender); unknown key -> default.
VOICES = [
    ("American Female (Standard)", "en-US-Standard-C", "FEMALE"),
    ("American Male (Standard)", "en-US-Standard-B", "MALE"),
    ("American Female (WaveNet)", "en-US-Wavenet-F", "FEMALE"),
    ("American Male (WaveNet)", "en-US-Wavenet-D", "MALE"),
    ("British Female (WaveNet)", "en-GB-Wavenet-A", "FEMALE"),
    ("British Male (WaveNet)", "en-GB-Wavenet-B", "MALE"),
    ("Australian Female (WaveNet)", "en-AU-Wavenet-C", "FEMALE"),
]
DEFAULT_VOICE = "American Female (WaveNet)"
AUDIO_ENCODING = "MP3"
DEFAULT_RATE = 1.0
MIN_RATE = 0.5
MAX_RATE = 1.5
SLOW_RATE_STEP = 0.3
DEFAULT_PITCH = 0.0

# Model settings per call site: (model, temperature).
DEFAULT_MODEL = "gpt-4o-mini"
TEMPERATURES = {
    "extraction": 0.2,
    "roleplay_setup": 0.7,
    "chat": 0.8,
    "feedback": 0.3,
    "modernise": 0.5,
}
TRANSCRIBE_MODEL = "whisper-1"
TRANSCRIBE_LANGUAGE = "en"

EXTRACTION_PROMPT = """You are an expert English literature analyst.
From the following book excerpt, extract ALL dialogue lines spoken by characters.

Return a JSON array. Each element must have:
- "speaker": the character name (or "Unknown" if unclear)
- "line": the exact dialogue text (without quotation marks)
- "context": a brief 1-sentence description of the situation
- "difficulty": one of "Beginner", "Intermediate", "Advanced"
  * Beginner: simple vocabulary, short sentences, everyday expressions
  * Intermediate: moderate vocabulary, idiomatic expressions, compound sentences
  * Advanced: complex vocabulary, literary expressions, long/nested sentences
- "modern_equivalent": a modern, natural rephrasing of the line (helpful for classic literature)
- "key_expressions": list of up to 3 notable phrases/idioms worth learning

Text: {text}

Respond ONLY with a valid JSON array. No extra text."""

ROLEPLAY_PROMPT = """You are an English conversation tutor.
Based on the following original dialogue from a book, create an interactive role-play scenario.

Original dialogue context: {context}
Dialogue lines:
{dialogue}

Create a role-play where:
1. The user plays one character (assign them the most interesting role)
2. You (AI) play all other characters
3. Keep the spirit of the original but allow natural conversation flow

Return JSON with:
- "scenario": scene description in English (2-3 sentences)
- "user_role": character name the user will play
- "ai_roles": list of character names the AI will play
- "opening_line": AI's first line to start the conversation
- "vocabulary_tips": list of 3-5 key phrases from this dialogue worth practicing

Respond ONLY with valid JSON."""

FEEDBACK_PROMPT = """You are an English pronunciation and fluency coach.
The user was practicing this target line:
Target: "{target}"
User said: "{user_input}"

Evaluate and provide feedback in JSON:
- "accuracy_score": integer 0-100
- "pronunciation_issues": list of specific words that may be mispronounced
- "fluency_feedback": one encouraging sentence about delivery
- "grammar_note": any grammar correction if needed (null if correct)
- "encouragement": a motivating closing remark

Respond ONLY with valid JSON."""

CHAT_SYSTEM_PROMPT = (
    "You are playing the following characters in a role-play: {roles}.\n"
    "Scenario: {scenario}\n"
    "Respond naturally in English as these characters. Keep responses concise (1-3 sentences). "
    "Stay in character at all times."
)
CHAT_ROLES_JOINER = ", "

MODERNISE_PROMPT = (
    "Rewrite this classic English text in modern, natural American English. "
    "Keep the same meaning but use contemporary vocabulary and phrasing.\n\nText: {text}"
)

HINT_PROMPT = "Translate to Korean naturally: {line}"

ANALYSIS_PROMPT = (
    "Analyze this English conversation practice. "
    "Give feedback on: vocabulary usage, grammar, naturalness, "
    "and suggestions for improvement. "
    "User's lines: {lines}"
)

# Transcript line format for the role-play prompt: speaker: "line" (trailing space).
TRANSCRIPT_LINE = '{speaker}: "{line}" '
TRANSCRIPT_JOINER = "\n"
KEY_EXPRESSION_JOINER = " · "
ISSUE_JOINER = ", "

# --------------------------------------------------------------------------
# Our own parameters (not from the reproduced application)
# --------------------------------------------------------------------------


def _literals(marker: str) -> list[str]:
    """The literal strings that a marker with one group of alternatives stands for."""
    plain = marker.replace("\\*", "*")
    head, _, rest = plain.partition("(")
    choices, _, tail = rest.partition(")")
    return [head + c + tail for c in choices.split("|")]


START_MARKERS, END_MARKERS = _literals(START_MARKER), _literals(END_MARKER)

# Offline rule-based difficulty tiers (U3): ours, documented in README.
RULE_BEGINNER_MAX_WORDS = 8
RULE_BEGINNER_MAX_WORD_LEN = 4.5
RULE_ADVANCED_MIN_WORDS = 20
RULE_ADVANCED_MIN_WORD_LEN = 6.0
