"""Column expressions: dates, amounts, merchant text cleaning, fuzzy scorers, money text."""
