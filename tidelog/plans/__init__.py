"""The three commands as DataFrame functions: capture (and replay), export, log inventory."""
