"""Every operator run on the test tables, each with its SQL check where SQL can express it."""
