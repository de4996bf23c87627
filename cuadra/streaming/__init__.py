from cuadra.streaming.statements import parse_statements, start_statement_stream

__all__ = ["parse_statements", "start_statement_stream"]
