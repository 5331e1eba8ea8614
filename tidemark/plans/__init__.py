"""Jobs: they put operators together and own all actions and writes."""
