"""Where data comes from and goes to: landing directories, stored tables, configuration."""
