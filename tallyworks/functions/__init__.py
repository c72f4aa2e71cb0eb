"""Column functions: text cleaning, classes, timestamps."""
