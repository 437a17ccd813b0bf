"""Domain plans: cleaning recipes, star load, views and reports."""
