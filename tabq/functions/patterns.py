"""Regular expressions shared by the rules (Java syntax, matched anywhere in the text)."""

# Fixed values.
ALPHA = r"[a-zA-Z]+"
INTEGER = r"[0-9]+"
FLOAT = r"[0-9]+\.[0-9]+"
ALPHANUM = r"[0-9a-zA-Z]+"
EMPTY_TAIL = r"[\t ]+$"
SPECIAL = r"[!@#$%&*\(\)_]+"
TAIL_NUMBER = r"^N[1-9][0-9]{2,3}([ABCDEFGHJKLMNPRSTUVXWYZ]{1,2})"
TAIL_NUMBER_INVALID = r"(N0.*$)|(.*[IO].*)"
CLOCK = r"^(([0-1]?[0-9])|(2[0-3]))([0-5][0-9])$"
INVOICE = r"c?([0-9]{6})"
DIGITS_ONLY = r"^[0-9]*$"
NO_DIGIT = r"^([^0-9]*)$"
LETTERS_ONLY = r"^[a-zA-Z ]*$"
NO_ALPHANUM = r"^[^0-9a-zA-Z]+$"
POSITIVE_DECIMAL = r"^([1-9]\d*(\.|\,)\d*|0?(\.|\,)\d*[1-9]\d*|[1-9]\d*)$"
AIRPORT_CODE = r"([A-Z]|[a-z]|[0-9]{3})"
FOUR_DIGITS = r"[0-9]{4}"
QUESTION_MARK = r"(\?)"


def any_of(words):
    """A pattern that finds any of the words; words are taken as regular expressions."""
    return "|".join(words)
