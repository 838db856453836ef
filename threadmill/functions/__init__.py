"""Column functions: text, titles, salary and region rules, report measures."""
