"""Declared input schemas (FIXTURES.md). Names are trimmed of the trailing blanks
the original files carried; dotted names become underscores."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()

MESSAGE_STRUCT_A = T.StructType([
    T.StructField("conversation_id", S), T.StructField("id", S), T.StructField("subject", S),
    T.StructField("date", S), T.StructField("body", S), T.StructField("from_name", S),
    T.StructField("from_email", S), T.StructField("to_recipients", T.ArrayType(S)),
    T.StructField("cc_recipients", T.ArrayType(S)),
])
CONVERSATIONS_A = T.MapType(S, T.ArrayType(MESSAGE_STRUCT_A))

PERSON_B = T.StructType([T.StructField("user_display_name", S), T.StructField("user_id", S),
                         T.StructField("email", S)])
MESSAGE_STRUCT_B = T.StructType([
    T.StructField("conversation_id", S), T.StructField("id", S), T.StructField("subject", S),
    T.StructField("date", S), T.StructField("body", S), T.StructField("from", PERSON_B),
    T.StructField("recipients", T.ArrayType(PERSON_B)),
])
CONVERSATIONS_B = T.ArrayType(MESSAGE_STRUCT_B)

# Normalized message rows the interest pipeline reads (both shapes map to it).
MESSAGES = T.StructType([
    T.StructField("conversation_id", S), T.StructField("message_id", S), T.StructField("subject", S),
    T.StructField("body", S), T.StructField("date", S), T.StructField("from_email", S),
    T.StructField("to", T.ArrayType(S)), T.StructField("cc", T.ArrayType(S)),
])

# F4 message table (CSV). All strings on read except the two integer keys.
MESSAGE_TABLE_COLUMNS = {
    "row_seq": "row_seq", "conversationId": "conversationId", "id": "id", "subject": "subject",
    "body.content": "body_content", "receivedDateTime": "receivedDateTime", "fromEmailAddress": "fromEmailAddress",
    "toRecipients": "toRecipients", "ccRecipients": "ccRecipients", "comment": "comment", "commentBy": "commentBy",
    "_allow_permissions": "_allow_permissions", "from_user": "from_user", "type": "type",
}
COMPANION_COLUMNS = {"row_seq": "row_seq", "commentDate": "commentDate", "Component.s": "component"}
DIRECTORY_COLUMNS = {"cognitoSubjectId (S)": "sub_id", "email (S)": "email_id", "displayName (S)": "user_name"}

PROFILE = T.StructType([
    T.StructField("user_id", S), T.StructField("category", S), T.StructField("value", S),
    T.StructField("frequency", L), T.StructField("decay_frequency", L), T.StructField("batch_id", S),
])
NESTED_PROFILE = T.MapType(S, T.MapType(S, T.MapType(S, L)))
