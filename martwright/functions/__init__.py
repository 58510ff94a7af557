"""Column helpers: money and rounding, text cleaning, calendar parts."""
