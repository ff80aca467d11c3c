"""Which node types are blocks and sub-blocks, per language.

Three entries describe the built-in scanners.  The others are for node tables produced by
an external parser; further languages come from a JSON file of the same shape
(``{"language": {"block_types": [...], "subblock_types": [...]}}``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

RULE_SCHEMA = "language string, role string, node_type string"

SCANNER_RULES = {
    "prose": {"block_types": ["paragraph"], "subblock_types": ["sentence"]},
    "brace": {"block_types": ["definition"], "subblock_types": ["body", "statement"]},
    "keyword": {
        "block_types": [
            "function_block_declaration",
            "function_declaration",
            "program_declaration",
            "method_declaration",
            "class_declaration",
        ],
        "subblock_types": ["statement"],
    },
    "indent": {
        "block_types": ["function_definition", "class_definition"],
        "subblock_types": [
            "block", "assignment", "expression_statement", "if_statement", "while_statement", "for_statement",
            "match_statement", "case_clause", "return_statement", "try_statement", "except_clause",
            "finally_clause", "with_statement", "yield",
        ],
    },
}

# Node types by language.
PARSER_RULES = {
    "c": {
        "block_types": ["function_definition", "struct_specifier", "union_specifier", "enum_specifier"],
        "subblock_types": [
            "compound_statement", "parameter_list", "declaration", "expression_statement", "if_statement",
            "while_statement", "for_statement", "switch_statement", "case_statement", "return_statement",
            "field_declaration_list", "field_declaration", "enumerator_list", "enumerator",
        ],
    },
    "python": {
        "block_types": ["function_definition", "class_definition", "decorated_definition", "async_function"],
        "subblock_types": [
            "block", "parameters", "assignment", "expression_statement", "if_statement", "while_statement",
            "for_statement", "match_statement", "case_clause", "return_statement", "decorated_definition",
            "try_statement", "except_clause", "finally_clause", "with_statement", "lambda", "yield",
        ],
    },
    "cpp": {
        "block_types": [
            "function_definition", "class_specifier", "struct_specifier", "union_specifier", "enum_specifier",
            "template_declaration", "namespace_definition",
        ],
        "subblock_types": [
            "compound_statement", "parameter_list", "declaration", "expression_statement", "if_statement",
            "while_statement", "for_statement", "switch_statement", "case_statement", "return_statement",
            "field_declaration_list", "field_declaration", "enumerator_list", "enumerator", "try_statement",
            "catch_statement",
        ],
    },
    "java": {
        "block_types": [
            "method_declaration", "class_declaration", "interface_declaration", "enum_declaration",
            "record_declaration", "constructor_declaration",
        ],
        "subblock_types": [
            "block", "formal_parameters", "local_variable_declaration", "expression_statement", "if_statement",
            "while_statement", "for_statement", "enhanced_for_statement", "switch_expression", "switch_rule",
            "case_label", "return_statement", "throw_statement", "catch_clause", "finally_clause",
            "yield_statement", "try_statement", "try_with_resources_statement", "synchronized_statement",
            "static_initializer",
        ],
    },
    "javascript": {
        "block_types": [
            "function_declaration", "function_expression", "arrow_function", "method_definition",
            "class_declaration", "generator_function_declaration",
        ],
        "subblock_types": [
            "statement_block", "formal_parameters", "lexical_declaration", "variable_declaration",
            "expression_statement", "assignment_expression", "augmented_assignment_expression", "if_statement",
            "while_statement", "for_statement", "for_in_statement", "for_of_statement", "switch_statement",
            "try_statement",
        ],
    },
    "go": {
        "block_types": ["function_declaration", "method_declaration", "func_literal"],
        "subblock_types": [
            "block", "parameter_list", "short_var_declaration", "assignment_statement", "inc_statement",
            "expression_statement", "if_statement", "for_statement", "expression_switch_statement",
            "select_statement", "go_statement", "defer_statement", "return_statement",
        ],
    },
    "rust": {
        "block_types": [
            "function_item", "function_signature_item", "impl_item", "trait_item", "struct_item", "enum_item",
            "mod_item", "closure_expression",
        ],
        "subblock_types": [
            "block", "parameters", "let_declaration", "expression_statement", "if_expression", "while_expression",
            "for_expression", "loop_expression", "match_expression", "match_arm", "return_expression",
            "field_declaration_list", "enum_variant_list", "declaration_list", "compound_assignment_expr",
        ],
    },
    "swift": {
        "block_types": ["function_declaration", "class_declaration", "protocol_declaration", "closure_expression"],
        "subblock_types": [
            "function_body", "statements", "property_declaration", "assignment", "if_statement", "while_statement",
            "for_statement", "switch_statement", "guard_statement", "do_statement", "return_statement",
        ],
    },
    "vhdl": {
        "block_types": [
            "entity_declaration", "architecture_body", "process_statement", "package_declaration",
            "configuration_declaration", "generate_statement",
        ],
        "subblock_types": [
            "signal_assignment", "variable_assignment", "if_statement", "case_statement", "loop_statement",
            "wait_statement", "assert_statement", "component_instantiation", "concurrent_statement",
            "sequential_statement",
        ],
    },
    "bash": {
        "block_types": ["function_definition", "compound_statement", "subshell", "pipeline", "list"],
        "subblock_types": [
            "command", "variable_assignment", "redirected_statement", "expression", "assignment", "test_command",
            "negated_command", "break_statement", "continue_statement", "return_statement", "command_substitution",
            "process_substitution", "arithmetic_expansion", "if_statement", "while_statement", "for_statement",
            "c_style_for_statement", "case_statement",
        ],
    },
    "mojo": {
        "block_types": [
            "function_definition", "struct_definition", "trait_definition", "class_definition", "enum_definition",
        ],
        "subblock_types": [
            "compound_statement", "parameter_list", "declaration", "expression_statement", "return_statement",
            "assignment", "augmented_assignment", "try_statement", "catch_clause", "finally_clause",
            "decorated_definition",
        ],
    },
    "iec61131_3_st": {
        "block_types": [
            "function_block_declaration", "function_declaration", "program_declaration", "method_declaration",
            "structure_type_inline", "enumerated_type_inline",
        ],
        "subblock_types": [
            "var_block", "var_input", "var_output", "var_in_out", "var_temp", "var_external",
            "variable_declaration", "assignment_statement", "invocation_statement", "if_statement",
            "case_statement", "case_clause", "for_statement", "while_statement", "repeat_statement",
            "return_statement", "exit_statement", "structure_field", "enumerator",
        ],
    },
}


@dataclass(frozen=True)
class LanguageRules:
    language: str
    block_types: list[str]
    subblock_types: list[str]


def built_in_rules(spark: SparkSession) -> DataFrame:
    rows = [
        (language, role, node_type)
        for language, roles in {**SCANNER_RULES, **PARSER_RULES}.items()
        for role, types in roles.items()
        for node_type in types
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA).distinct()


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule table from a JSON file; languages whose entries are not both lists are kept as errors."""
    roles = "struct<block_types:array<string>,subblock_types:array<string>>"
    text = spark.read.text(path, wholetext=True)
    by_language = text.select(F.explode(F.from_json("value", f"map<string,{roles}>")).alias("language", "roles"))
    return by_language.select(
        "language",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(role).alias("role"), F.col(f"roles.{role}").alias("types"))
                    for role in ("block_types", "subblock_types")
                ]
            )
        ).alias("entry"),
    ).select("language", F.col("entry.role").alias("role"), F.explode_outer("entry.types").alias("node_type")).distinct()


def language_rules(rules: DataFrame, language: str) -> LanguageRules:
    """The two type lists of one language; raises for an unknown or incomplete language."""
    rows = rules.where(F.col("language") == language).collect()
    if not rows:
        raise ValueError(f"no rules for language '{language}'")
    types = {
        role: sorted(r["node_type"] for r in rows if r["role"] == role and r["node_type"] is not None)
        for role in ("block_types", "subblock_types")
    }
    if any(r["node_type"] is None for r in rows) or not all(types.values()):
        raise ValueError(f"incomplete rules for language '{language}'")
    return LanguageRules(language, types["block_types"], types["subblock_types"])


def scanner_rules(scanner: str) -> LanguageRules:
    if scanner not in SCANNER_RULES:
        raise ValueError(f"no built-in scanner '{scanner}'")
    rules = SCANNER_RULES[scanner]
    return LanguageRules(scanner, rules["block_types"], rules["subblock_types"])
