"""Structured Streaming: the sessionizer over an event stream and a binding
over the session rows it writes."""
